import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm import hard_negatives as d

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every, m):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (str(label), [math.floor(m.scale * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, key), key)
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(v, w, strict=False)) for b, (_, w) in kept.items()}
        by = lambda b: (-score[b], b)
        same = sorted((b for b in kept if b != a and kept[b][0] == label), key=by)[: m.positives]
        for p in same:
            other = [b for b in kept if kept[b][0] != label and m.low * score[p] <= 100 * score[b] <= m.high * score[p]]
            for rank, b in enumerate(sorted(other, key=by)[: m.negatives], 1):
                out.append((a, p, rank, b, score[p], score[b]))
    return sorted(out)


def corpus(seed, n, width=8, labels=4):
    chosen = np.random.default_rng(seed)
    centres = chosen.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = centres[chosen.integers(6)] + chosen.normal(size=width) * 0.4
        rows.append((i, [float(np.float32(x)) for x in v], int(chosen.integers(labels))))
    return rows


def odd(rows):
    width = len(rows[0][1])
    copy = rows[10][1]
    return [
        *rows,
        *((1000 + i, copy, i % 3) for i in range(60)),  # one very common vector
        *[rows[20]] * 5,  # rows that repeat
        (30, [0.5] * width, 0),  # an id with another vector
        (2000, None, 1), (2001, [1.0] * width, None), (None, copy, 1), (2002, [*copy[1:], None], 1),
        (2003, [*copy[1:], float("nan")], 1), (2004, [*copy[1:], float("inf")], 1),
        (2010, [], 1), (2015, [0.0] * width, 2), (2020, copy[:3], 2), (2025, [*copy, 0.25, 0.5], 1),
        (2030, [-x for x in copy], 9),  # a label of its own: no positives
        (-5, copy, 2), (-7, copy, 1),
    ]


def got(spark, rows, m=d.Mining(), every=5, **options):  # noqa: B008
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(3)
    found = d.mine(df, F.col("id") % every == 0, m=m, **options)
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()))


def test_equals_brute_force(spark):
    rows = odd(corpus(1, 150))
    want = brute(rows, 5, d.Mining())
    assert got(spark, rows) == want and len(want) > 100
    assert got(spark, rows, anchor_bytes=700) == want  # several blocks of anchors


def test_other_parameters(spark):
    rows = corpus(2, 90, width=3, labels=60)
    m = d.Mining(scale=7, positives=2, negatives=6, low=10, high=100)
    assert got(spark, rows, m, every=2) == brute(rows, 2, m)


def test_scores_beyond_doubles(spark):
    """Products of more than 53 bits: neighbours differ in the last one."""
    chosen = random.Random(3)
    rows = [(i, [float(np.float32(chosen.choice([2.0**21, 2.0**21 + 0.25, 1.5, -1.0]))) for _ in range(4)], i % 3) for i in range(60)]
    m = d.Mining(low=0, high=100)
    want = brute(rows, 5, m)
    assert got(spark, rows, m) == want and max(abs(r[4]) for r in want) > 2**53


def test_empty_tables(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []  # no anchors
    assert got(spark, [(5, [1.0], 0), (2, [1.0], 1)]) == []  # an anchor without positives


@pytest.mark.parametrize("n", [1, 31, 32, 33, 1000])
def test_reading_stops_early_and_bounds_hold(n):
    chosen = np.random.default_rng(n)
    vectors = chosen.integers(-50, 50, (n, 6)).astype(float)
    block = d.Block(np.arange(n), vectors)
    for anchor in (vectors[0], np.zeros(6), np.array([1.0, 0, 0, 0, 0, -2.0])):
        scores, seen = vectors @ anchor, np.zeros(n, bool)
        for places, found, bound in block.read(anchor):
            assert not seen[places].any() and (found == scores[places]).all()
            seen[places] = True
            assert not (~seen).any() or scores[~seen].max() <= bound
        assert seen.all()
    best, read = d.Best(1), 0
    for places, found, bound in block.read(np.array([1.0, 0, 0, 0, 0, 0])):
        best.offer(places, found)
        read += len(places)
        if best.closed(bound):
            break
    assert -best.found[0][0] == vectors[:, 0].max() and (n < 1000 or read < n / 2)
