"""Hard negatives against all pairs by hand."""

import random

import pytest

from baitline.llm.negative_mining import BLOCK_ROWS, Lists, hard_negatives
import numpy as np

SCHEMA = "vec_id long, label int, vector array<long>, score string, id int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def plain(rows, anchors, positives=5, negatives=3):
    rows = [r for r in rows if None not in r[:3]]
    out = []
    for me in sorted({a[0] for a in anchors if None not in a[:3]}):
        _, label, v = min((a for a in anchors if a[0] == me and None not in a[:3]), key=lambda a: (a[1], a[2]))
        ranked = sorted((-dot(v, r[2]), r[0], r[1]) for r in rows if r[0] != me)
        for score, one, _ in [r for r in ranked if r[2] == label][:positives]:
            fits = [r for r in ranked if r[2] != label and -50 * score <= -100 * r[0] <= -95 * score]
            out += [(me, one, k, r[1], -score, -r[0]) for k, r in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchors, parts=3, **more):
    found = hard_negatives(table(spark, rows).repartition(parts), table(spark, anchors), **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("spread", [3, 100, 1 << 28])
def test_equals_all_pairs(spark, spread):
    rng = random.Random(spread)
    def vector():
        return [rng.randint(-spread, spread) for _ in range(6)]
    rows = [(i, rng.randrange(4), vector()) for i in range(600)]
    rows += [(700 + i, 1, rows[5][2]) for i in range(200)]  # a group of copies in a large label
    rows += [(900, 2, [0] * 6), (901, 2, [1, 2]), (3, 0, vector()), (3, 3, vector()), (None, 1, vector()),
             (902, None, vector()), (903, 1, None)]
    anchors = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [rows[3], rows[3], rows[-5], rows[-3]]
    assert mined(spark, rows, anchors) == plain(rows, anchors)
    assert mined(spark, rows, anchors, block=7) == plain(rows, anchors)


def test_reading_stops_early_where_few_rows_stand_out():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-5, 5, (BLOCK_ROWS, 4))
    vectors[17] = vectors[99] = [90, 90, 90, 90]
    lists = Lists(np.arange(BLOCK_ROWS), np.zeros(BLOCK_ROWS, np.int64), vectors)
    asked = []
    scored = lists.scores
    lists.scores = lambda who, anchor: asked.append(len(who)) or scored(who, anchor)
    found = lists.search(np.array([1, 2, 1, 0]), np.ones(BLOCK_ROWS, bool), [(-10**9, 10**9)], 2, [None])
    assert found[0][0].tolist() == [17, 99] and sum(asked) < 100


def test_ties_at_the_threshold_are_not_missed():
    vectors = np.array([[5, 0]] * 40 + [[0, 5]] * 40)
    lists = Lists(np.arange(80)[::-1].copy(), np.zeros(80, np.int64), vectors)
    found = lists.search(np.array([1, 1]), np.ones(80, bool), [(0, 100)], 3, [None])
    assert found[0][0].tolist() == [0, 1, 2]


def test_empty_and_extremes(spark):
    assert mined(spark, [], []) == []
    assert mined(spark, [(1, 0, [1])], [(1, 0, [1])]) == []
    rows = [(1, 0, [1 << 62, 1 << 62]), (2, 0, [1 << 62, 1 << 62])]
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, rows, rows)
