"""Search and coding of vectors against comparing all with all."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from tallybrook.llm import nearest, vector_codes
from tallybrook.llm.vectors import BoxTree

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = "row v length cell part asks kth kth_id rank score query_id ids labels orders parts width code error hot_key fact_key".split()
NAN, INF = float("nan"), float("inf")


def vectors(count, width, seed, hot=0.3):
    """Clustered vectors, a share of them equal, ids out of order; some that take no part."""
    make = random.Random(seed)
    centres = [[make.uniform(-1, 1) for _ in range(width)] for _ in range(7)]
    rows = []
    for i in range(count):
        if make.random() < hot:
            v = [round(x, 2) for x in centres[0]]
        else:
            v = [x + make.gauss(0, 0.1) for x in make.choice(centres)]
        rows.append((i, v, make.choice([1, 2, 3, None])))
    make.shuffle(rows)
    bad = [(count, None, 1), (count + 1, [None] + [0.5] * (width - 1), 1), (count + 2, [NAN] * width, 2), (0, [INF] + [0.0] * (width - 1), 3)]
    again = [rows[0], rows[1], rows[1], (0, rows[2][1], None), (None, rows[3][1], None), (None, rows[4][1], 2)]
    return rows + bad + again


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def as_stored(rows):
    """The vectors as the float column holds them."""
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]


def found(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=lambda r: (r[0], r[1], r[2] is None, r[2], r[3]))


# -- trees ----------------------------------------------------------------------

def test_tree_boxes_are_tight_and_leaves_small():
    make = np.random.default_rng(3)
    points = np.concatenate([make.integers(-50, 50, (700, 5)), np.full((300, 5), 7)])
    tree = BoxTree(points, 16, make.permutation(1000))
    ordered = points[tree.order]
    assert sorted(tree.order.tolist()) == list(range(1000))
    for n, (a, b) in enumerate(zip(tree.start, tree.end)):
        assert (tree.low[n] == ordered[a:b].min(0)).all() and (tree.high[n] == ordered[a:b].max(0)).all()
        if tree.left[n] < 0:
            assert b - a <= 16
        else:
            left, right = tree.left[n], tree.right[n]
            assert (tree.start[left], tree.end[left], tree.end[right]) == (a, tree.start[right], b) and abs(2 * tree.end[left] - a - b) <= 1


# -- search ---------------------------------------------------------------------

@pytest.mark.parametrize("rows, sample", [(64, 100), (4096, 5000), (50, 0)])
def test_top_k_equals_comparing_all(spark, rows, sample):
    given = vectors(1500, 6, 1)
    got = nearest.top_k(frame(spark, given), every=50, rows=rows, sample=sample)
    assert found(got) == brute.top_k([r[:2] for r in as_stored(given)], every=50)


def test_ties_go_to_the_smaller_id(spark):
    given = [(i, [0.5, 0.25], 1) for i in range(2000, 0, -1)] + [(3000, [-1.0, 0.0], 1)]
    got = found(nearest.top_k(frame(spark, given), rows=100, sample=200))
    assert got == brute.top_k([r[:2] for r in given])
    assert [r[2] for r in got if r[0] == 100] == list(range(1, 11))


def test_few_candidates_lengths_and_empty_vectors(spark):
    given = [(0, [1.0, 2.0], 1), (1, [0.5, 0.5], 1), (100, [1.0, 2.0, 3.0], 1), (200, [], 1), (201, [], 1), (300, [4.0], 1)]
    got = found(nearest.top_k(frame(spark, given)))
    assert got == brute.top_k([r[:2] for r in given]) == [(0, 1, 1, 1536 * 1024), (200, 1, 201, 0)]


def test_search_bounds(spark):
    """Negative components, queries worse than all, and whole results with a bound that is met exactly."""
    make = random.Random(5)
    given = [(i, [make.choice([-2.0, -1.0, 0.0, 1.0]) for _ in range(4)], 1) for i in range(900)]
    assert found(nearest.top_k(frame(spark, given), k=3, every=7, rows=40, sample=30)) == brute.top_k([r[:2] for r in given], 3, 7)


def test_large_components(spark):
    given = [(i, [float(i % 50) * 2.0**13, -(2.0**12) * (i % 7)], 1) for i in range(400)]
    assert found(nearest.top_k(frame(spark, given), rows=64)) == brute.top_k([r[:2] for r in given])
    with pytest.raises(Exception, match="too large"):
        nearest.top_k(frame(spark, [(0, [1e30], 1), (1, [1.0], 1)])).collect()


def test_search_of_nothing(spark):
    none = frame(spark, vectors(10, 4, 2)).limit(0)
    assert nearest.top_k(none).collect() == [] and nearest.top_k(none).columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest.top_k(spark.createDataFrame([(0, None, 1), (100, [NAN], 1)], SCHEMA)).collect() == []


def test_search_and_codes_with_other_columns(spark):
    given = vectors(300, 8, 4)
    wide = frame(spark, given).withColumns({c: F.lit("x") for c in ODD})
    assert found(nearest.top_k(wide, every=50)) == brute.top_k([r[:2] for r in as_stored(given)], every=50)
    assert coded(vector_codes.report(wide, 16)) == expected(given, 16)


# -- codes ----------------------------------------------------------------------

def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def coded(df):
    return order((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def expected(rows, entries=256, rounds=4):
    return order(brute.vector_codes(as_stored(rows), entries, rounds))


@pytest.mark.parametrize("count, width, entries, block", [(700, 8, 32, 128), (90, 4, 256, 2048), (400, 16, 1, 100), (600, 12, 100, 37)])
def test_codes_equal_comparing_all(spark, count, width, entries, block):
    given = vectors(count, width, count)
    assert coded(vector_codes.report(frame(spark, given), entries, 4, block)) == expected(given, entries)


def test_equal_entries_and_ties(spark):
    given = [(i, [float(i % 3), 1.0, 0.0, float(i % 2)], i % 2) for i in range(200)]
    assert coded(vector_codes.report(frame(spark, given), 20)) == expected(given, 20)


def test_dual_tree_equals_all_distances():
    make = np.random.default_rng(8)
    for width in (1, 3, 16):
        for spread in (4, 1000):
            points = make.integers(-spread, spread, (500, width))
            entries = make.integers(-spread, spread, (60, width))
            tree = BoxTree(points, vector_codes.LEAF)
            ordered = points[tree.order]
            code, whole = vector_codes.nearest(ordered, vector_codes._Runs(ordered), vector_codes.EntryTree(entries))
            assert (code == ((ordered[:, None] - entries[None]) ** 2).sum(2).argmin(1)).all()
            for a, b, entry in whole:
                assert (code[a:b] == entry).all()


def test_far_clusters_are_assigned_as_a_whole():
    points = np.concatenate([np.arange(600).reshape(-1, 1) % 10, 10_000 + np.arange(600).reshape(-1, 1) % 10])
    tree = BoxTree(points, vector_codes.LEAF)
    ordered = points[tree.order]
    _, whole = vector_codes.nearest(ordered, vector_codes._Runs(ordered), vector_codes.EntryTree(np.array([[5], [10_005], [77]])))
    assert len(whole) < 10
    assert [sum(b - a for a, b, e in whole if e == k) for k in range(3)] == [600, 600, 0]


def test_codes_of_nothing_and_refusals(spark):
    none = frame(spark, vectors(10, 4, 2)).limit(0)
    assert vector_codes.report(none).collect() == []
    assert vector_codes.report(spark.createDataFrame([(1, None, None), (2, [None, 1.0], 3)], SCHEMA)).collect() == []
    for rows in ([(1, [1.0, 2.0, 3.0], 1)], [(1, [1.0] * 4, 1), (2, [1.0] * 8, 1)]):
        with pytest.raises(Exception, match="must all have one length"):
            vector_codes.report(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
