"""Rules and expressions against evaluating them step by step."""

import random

import pytest
from pyspark.sql import functions as F

from tallybrook.operators import rules
from tallybrook.operators.rules import Expression, Rule
from tallybrook.schemas import SAMPLES

INF = float("inf")


def table(spark, rows):
    """(metric, second, labels, value[, le]) as samples."""
    full = [(float(t), m, labels, r[0] if r else None, float(v)) for m, t, labels, v, *r in rows]
    return spark.createDataFrame(full, "s double, metric string, labels map<string,string>, le double, value double").select(
        F.timestamp_seconds("s").alias("ts"), "metric", "labels", "le", "value")


def text(labels):
    return ",".join(f"{k}={v}" for k, v in sorted(labels.items()))


def step_by_step(rows, expressions, start, end, step):
    """{(name, labels, t): value}, with a look at all samples at each step."""
    out = {}
    for name, e in expressions.items():
        for t in range(start, end + 1, step):
            series = {}
            for metric, at, labels, value, *le in sorted(rows, key=lambda r: r[1]):
                if metric == e.metric and t - e.window < at <= t and all(labels.get(k) == v for k, v in e.matching):
                    series.setdefault((text(labels), le[0] if le else None), []).append((labels, value))
            groups = {}
            for (key, le), own in series.items():
                if e.reading == "value":
                    value = own[-1][1]
                elif len(own) < 2:
                    continue
                else:
                    value = sum(b if b < a else b - a for (_, a), (_, b) in zip(own, own[1:]))
                group = key if e.total is None else text({k: v for k, v in own[0][0].items() if k in e.by})
                groups.setdefault(group, {}).setdefault(le, []).append(value)
            for group, by_le in groups.items():
                total = {le: max(v) if e.total == "max" else sum(v) for le, v in by_le.items()}
                if e.quantile is not None:
                    value = quantile(sorted(total.items()), e.quantile)
                else:
                    (value,) = total.values()
                    value = value / e.window if e.reading == "rate" else value
                if value is not None:
                    out[name, group, t] = value
    return out


def quantile(buckets, q):
    low, below, rank = 0.0, 0.0, q * buckets[-1][1]
    for le, held in buckets:
        if held >= rank and held > 0:
            return low if le == INF or held == below else low + (le - low) * (rank - below) / (held - below)
        low, below = le, held
    return None


def samples_of(seed):
    """Counters that start anew, a gauge and a histogram, with pauses and over midnight."""
    rng, rows = random.Random(seed), []
    for part in ("a", "b", "c"):
        t, count, held = 86_400 - rng.randrange(900, 1500), 0, [0, 0, 0]
        while t < 86_400 + 2000:
            t += rng.choice([15, 15, 15, 40, 400 if rng.random() < 0.2 else 15])
            if rng.random() < 0.05:
                count, held = 0, [0, 0, 0]
            count += rng.randrange(5)
            slow = rng.randrange(3)
            held = [n + (k >= slow) for k, n in enumerate(held)]
            rows.append(("jobs_total", t, {"part": part, "kind": "x"}, count))
            rows.append(("depth", t, {"part": part}, rng.randrange(100)))
            rows += [("delay_bucket", t, {"part": part}, n, le) for le, n in zip((0.5, 2.0, INF), held)]
    return rows


EXPRESSIONS = {
    "by series": Expression("jobs_total", "increase", 300),
    "all": Expression("jobs_total", "rate", 60, "sum"),
    "by part": Expression("jobs_total", "rate", 120, "max", ("part",)),
    "one": Expression("depth", matching=(("part", "b"),)),
    "deepest": Expression("depth", window=100, total="max"),
    "p90": Expression("delay_bucket", "rate", 300, "sum", quantile=0.9),
    "p50 by part": Expression("delay_bucket", "rate", 200, "sum", ("part",), quantile=0.5),
}
SPAN = (85_000, 88_900, 30)


@pytest.mark.parametrize("seed", range(3))
def test_expressions_equal_step_by_step(spark, seed):
    rows = samples_of(seed)
    got = {(r["name"], r["labels"], r["t"]): r["value"] for r in rules.evaluate(table(spark, rows), EXPRESSIONS, *SPAN).collect()}
    want = step_by_step(rows, EXPRESSIONS, *SPAN)
    assert set(got) == set(want) and len({name for name, _, _ in got}) == len(EXPRESSIONS)
    assert all(got[k] == pytest.approx(v) for k, v in want.items())


def test_quantile_of_a_rate_over_a_reset(spark):
    """The counts after a restart are growth from zero in each bucket, so the quantile is that of what came in."""
    rows = []
    for t, held in ((0, (10, 10)), (60, (10, 14)), (120, (1, 3)), (180, (1, 9))):
        rows += [("delay_bucket", t, {}, n, le) for le, n in zip((1.0, INF), held)]
    e = {"p": Expression("delay_bucket", "rate", 240, "sum", quantile=0.05)}
    (row,) = rules.evaluate(table(spark, rows), e, 180, 180, 60).collect()
    assert row["value"] == pytest.approx(0.65)


def test_one_scan_for_all_rules(spark, tmp_path):
    table(spark, samples_of(0)).write.parquet(str(tmp_path / "s"))
    stored = spark.read.schema(SAMPLES).parquet(str(tmp_path / "s"))
    plan = rules.alert_states(stored, rules.ALERT_RULES, 0, 3600, 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [In(metric" in plan and "NestedLoop" not in plan


def judged(rows, rule, step, times, first=0):
    """(labels, t): state, by walking through the evaluations."""
    values = step_by_step(rows, {rule.alert: rule.expression}, first, first + step * (times - 1), step)
    test = {"==": lambda v: v == rule.threshold, ">": lambda v: v > rule.threshold}[rule.comparison]
    out, since = {}, {}
    for t in range(first, first + step * times, step):
        here = {g: v for (_, g, at), v in values.items() if at == t}
        recent = any(r[0] == rule.expression.metric and t - rule.fresh < r[1] <= t for r in rows)
        active = {g: test(v) for g, v in here.items()}
        if rule.absent and not recent:
            active[""] = True
        for g in {*active, *since}:
            if not active.get(g):
                since.pop(g, None)
            else:
                since.setdefault(g, t)
        for g, on in active.items():
            out[g, t] = "inactive" if not on else "firing" if t - since[g] >= rule.for_seconds else "pending"
    return out


RULES = (
    Rule("Quiet", Expression("jobs_total", "rate", 60, "sum"), "==", 0, 120, "critical", absent=True, fresh=200),
    Rule("Deep", Expression("depth"), ">", 40, 60, "warning"),
    Rule("Grown", Expression("jobs_total", "increase", 300), ">", 12, 0, "warning"),
    Rule("Slow", Expression("delay_bucket", "rate", 300, "sum", quantile=0.9), ">", 1.5, 100, "warning"),
)


@pytest.mark.parametrize("seed", range(2))
def test_states_equal_walking(spark, seed):
    rows = samples_of(seed)
    start, end, step = SPAN
    got = {}
    for r in rules.alert_states(table(spark, rows), RULES, start, end, step).collect():
        got.setdefault(r["alert"], {})[r["labels"], r["t"]] = r["state"]
    for rule in RULES:
        assert got[rule.alert] == judged(rows, rule, step, (end - start) // step + 1, start), rule.alert
    assert {"inactive", "pending", "firing"} <= {s for own in got.values() for s in own.values()}


def test_a_vanished_series_is_no_zero(spark):
    """Growth of a series that is gone has no value: only ``absent`` sees that, until samples are back."""
    rows = [("jobs_total", t, {"part": "a"}, t) for t in range(0, 301, 15)]
    plain = Rule("Zero", Expression("jobs_total", "rate", 60, "sum"), "==", 0, 60, "critical")
    covered = Rule("Gone", Expression("jobs_total", "rate", 60, "sum"), "==", 0, 60, "critical", absent=True, fresh=120)
    found = {(r["alert"], r["t"]): r["state"] for r in rules.alert_states(table(spark, rows), [plain, covered], 0, 600, 60).collect()}
    assert {s for (a, _), s in found.items() if a == "Zero"} == {"inactive"}
    assert [found.get(("Gone", t)) for t in (300, 360, 420, 480, 540)] == ["inactive", None, "pending", "firing", "firing"]


def test_the_pipelines_rules():
    by_name = {r.alert: r for r in rules.ALERT_RULES}
    assert len(by_name) == 8 and all(r.severity in ("critical", "warning") for r in by_name.values())
    # A rate that compares with zero says nothing of a series that is gone.
    assert all(r.absent for r in by_name.values() if r.expression.reading == "rate" and r.comparison == "==")
    slower = by_name["FreshnessSLOBreached"].scaled(60)
    assert (slower.expression.window, slower.for_seconds, slower.expression.quantile) == (18_000, 18_000, 0.99)


def test_refusals():
    for wrong in (dict(reading="delta"), dict(window=0), dict(total="avg"), dict(quantile=0.5), dict(total="sum", quantile=2.0)):
        with pytest.raises(ValueError):
            Expression("m", **wrong)


def test_no_samples(spark):
    none = table(spark, samples_of(0)).limit(0)
    assert rules.evaluate(none, EXPRESSIONS, *SPAN).count() == 0
    assert {r["state"] for r in rules.alert_states(none, RULES, *SPAN).collect()} == {"pending", "firing"}
