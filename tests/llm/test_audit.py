"""The filter audit against applying every order of the filters, one after the other."""

from itertools import permutations
from math import factorial

import pytest
from pyspark.sql import functions as F

import brute
from tallybrook.llm import filter_audit
from tallybrook.llm.base import spread_join, stored

NAMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PROSE = " ".join(f"word{k}" for k in range(60))
DOCS = [
    (1, PROSE, "a"), (2, PROSE, "b"), (3, None, "a"), (4, "", None), (5, "LOUD " * 70, "a"), (6, f"{PROSE} 5 %", ""),
    (7, "short", "a"), (8, "short", "a"), (None, "short", "a"), (None, PROSE, None), (9, PROSE + " é \t end", "b"),
    (1, PROSE, "a"), (7, "short", "a"), (10, "x | y " * 5000, "b"), (11, "ab " * 100, "a"), (7, "other words", "b"), (12, PROSE, None),
]
LABELS = [(1, 1, 0), (1, 0, 0), (7, 0, 1), (8, 1, 1), (None, 1, 1), (3, None, 1), (5, 1, None), (99, 1, 1)]
ODD = "part fails n good toxic state left edge next filter orders of by before f step digest first words hot_key fact_key kept".split()


def measured(df):
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in NAMES) for r in rows}


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    return docs, labels


def test_every_path_is_counted():
    for count in (1, 3, 5):
        through = {(s, f): w for s, f, _, w in filter_audit.paths(count)}
        seen = {}
        for order in permutations(range(count)):
            state = 0
            for f in order:
                seen[state, f] = seen.get((state, f), 0) + 1
                state |= 1 << f
        assert through == seen


def test_equals_applying_each_order(tables):
    docs, labels = tables
    found = measured(filter_audit.report(docs, labels))
    assert found == brute.filter_audit(DOCS, LABELS)
    assert len(found) == 600 * len({part or "" for _, _, part in DOCS})


def test_shares_add_up_to_what_all_filters_remove(tables):
    for part, rows in _by_part(measured(filter_audit.report(*tables))).items():
        of_part = [d for d in DOCS if (d[2] or "") == part]
        removed = {order: sum(v[1] for (o, _), v in rows.items() if o == order) for order, _ in rows}
        assert len(set(removed.values())) == 1
        shares = {order[step - 1]: v[-1] for (order, step), v in rows.items()}
        assert sum(shares.values()) == factorial(5) * removed["ABCDE"] <= factorial(5) * len(of_part)


def _by_part(found):
    out = {}
    for (part, order, step), v in found.items():
        out.setdefault(part, {})[order, step] = v
    return out


def test_other_columns_and_names(tables):
    docs, labels = tables
    wide = docs.withColumns({c: F.lit("x") for c in ODD})
    marks = labels.withColumns({c: F.lit(7) for c in ODD if c not in ("toxic",)})
    assert measured(filter_audit.report(wide, marks)) == brute.filter_audit(DOCS, LABELS)


def test_empty_tables(tables):
    docs, labels = tables
    assert filter_audit.report(docs.limit(0), labels).count() == 0
    assert measured(filter_audit.report(docs, labels.limit(0))) == brute.filter_audit(DOCS, [])


def test_own_filters(spark):
    rows = [("p", 0, 5, 1, 0), ("p", 1, 2, 0, 2), ("p", 3, 4, 1, 1), ("q", 3, 1, 0, 0)]
    counted = spark.createDataFrame(rows, "part string, fails int, n long, good long, toxic long")
    found = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(counted, ("x", "y")).collect()}
    assert len(found) == 2 * 2 * 2
    assert (found["p", "xy", 1].removed, found["p", "xy", 2].removed, found["p", "xy", 2].redundant) == (6, 0, 4)
    assert (found["p", "yx", 1].removed, found["p", "yx", 2].removed, found["p", "yx", 1].shapley) == (4, 2, 4)
    assert found["q", "xy", 1].kept == found["q", "yx", 2].kept == 0
    with pytest.raises(ValueError):
        filter_audit.audit(counted, tuple("abcdefgh"))


def test_spread_join_is_a_left_join(spark):
    """A key with most rows, many small keys and null keys get the facts a plain join gives them."""
    keys = [1] * 5000 + list(range(2, 3000)) + [None] * 3000
    rows = stored(spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long"), "rows")
    facts = spark.createDataFrame([(k, f"f{k}") for k in [1, None, *range(2, 2000)]], "k long, fact string")
    found = {r.i: r.fact for r in spread_join(rows, facts, "k").collect()}
    assert found == {i: f"f{k}" if k is None or k < 2000 else None for i, k in enumerate(keys)}
