import math
import random

import duckdb
import numpy as np

from navedge.llm import hard_negatives as H
from navedge.llm.vectors import MOST, whole_scores

from .data import SF, collected, with_extra

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every, positives=5, negatives=3):
    v = [(i, a, [math.floor(256 * x) for x in e], label) for i, (a, e, label) in enumerate(rows)
         if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    score = lambda e, f: max(-MOST, min(MOST, sum(x * y for x, y in zip(e, f))))
    out = []
    for i, a, e, label in v:
        if a is None or a % every:
            continue
        near = sorted(((-score(e, f), b is None, b or 0, b, other) for j, b, f, other in v if j != i), key=lambda z: z[:3])
        for p in [z for z in near if z[4] == label][:positives]:
            fit = [z for z in near if z[4] != label and 50 * -p[0] <= 100 * -z[0] <= 95 * -p[0]][:negatives]
            out += [(a, p[3], rank, z[3], -p[0], -z[0]) for rank, z in enumerate(fit, 1)]
    return sorted(out, key=repr)


def test_ties_nulls_repeats_and_ragged_rows(spark):
    rng = random.Random(4)
    odd = [None, [None, 1.0], [float("nan"), 0.5], [float("inf")], []]
    rows = [(rng.randint(0, 150) if rng.random() > 0.05 else None,
             rng.choice(odd) if rng.random() < 0.1 else [rng.choice([0.5, -0.5, 1.0, 3.0, 0.125]) for _ in range(rng.choice([3, 4]))],
             rng.choice([0, 0, 0, 1, 2, 7, None])) for _ in range(400)]
    rows += [(50, [0.5, 0.5, 0.5], 1)] * 40
    got = H.mine(with_extra(spark, rows, SCHEMA).repartition(4), tree_rows=32, leaf_rows=4, anchors=7, group_rows=64)
    assert collected(got) == brute(rows, 50)


def test_a_hot_label_and_many_rare_ones(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 10)) * (2.0 ** -np.arange(10))
    rows = [(i, [float(v) for v in r], 0 if i % 3 else i) for i, r in enumerate(x)] + [(900, [2.0] * 10, None)]
    assert collected(H.mine(spark.createDataFrame(rows, SCHEMA), every=10, tree_rows=64, leaf_rows=8, anchors=16)) == brute(rows, 10)


def test_boxes_prune_and_never_lose():
    rng = np.random.default_rng(6)
    x = np.floor(rng.normal(size=(512, 4)) * 256)
    labels = rng.integers(0, 3, 512)
    at, sizes = H.tiles(x, labels, 16, [0, 1, 2, 3])
    assert sorted(at.tolist()) == list(range(512)) and sum(sizes) == 512 and max(sizes) <= 16
    trees = H.Trees([[np.arange(512)[at], np.arange(512)[at], labels[at], x[at], sizes]])
    q = x[:20]
    for at, level in enumerate(trees.levels):
        lower, upper = H.interval(q, level["lo"], level["hi"])
        for node in range(len(level["first"])):
            a, b, depth = node, node + 1, at
            while depth:
                a, b, depth = int(trees.levels[depth]["first"][a]), int(trees.levels[depth]["last"][b - 1]), depth - 1
            s = q @ trees.x[int(trees.levels[0]["first"][a]):int(trees.levels[0]["last"][b - 1])].T
            assert (lower[:, node] <= s.min(axis=1)).all() and (upper[:, node] >= s.max(axis=1)).all()
    meeting = H.Meeting(trees, q, np.arange(20), labels[:20])
    meeting.search(0, 5, True, [-MOST], [MOST])
    assert 0 < meeting.opened < len(trees.levels[0]["first"]) / 2
    opened = meeting.opened
    assert meeting.search(0, 3, False, [10 ** 9], [2 * 10 ** 9]) == [[]] and meeting.opened == opened


def test_scores_beyond_double_and_long(spark):
    big = np.array([[2.0 ** 60, 3.0], [1e200, 0.0]])
    assert whole_scores(big[:1], np.array([[1.0, 1.0]])).tolist() == [[(1 << 60) + 3]]
    assert whole_scores(big, big).tolist() == [[MOST, MOST], [MOST, MOST]] and whole_scores(-big, big).tolist()[1] == [-MOST, -MOST]
    rows = [(0, [1e17, 1.0], 1), (50, [2.0 ** 31, 2.0 ** 31], 1), (3, [1.0, 0.5], 1), (4, [0.25, 7.0], 2), (5, [-1e300, 2.0], 2), (6, [1e308, 1e308], 2),
            (7, [1e150, 1e150], 2), (100, [0.1, 0.2], 2)]
    kept = [r for r in rows if math.isfinite(256 * max(map(abs, r[1])))]
    assert collected(H.mine(spark.createDataFrame(rows, SCHEMA), tree_rows=2, leaf_rows=1)) == brute(kept, 50)


def test_few_or_no_rows(spark):
    assert H.mine(with_extra(spark, [], SCHEMA)).count() == 0
    assert H.mine(with_extra(spark, [(50, None, 1), (50, [1.0], None)], SCHEMA)).count() == 0
    assert H.mine(with_extra(spark, [(50, [1.0], 1)], SCHEMA)).count() == 0
    assert collected(H.mine(with_extra(spark, [(50, [1.0], 1), (1, [2.0], 1), (2, [1.0], 3)], SCHEMA))) == [(50, 1, 1, 2, 131072, 65536)]


def test_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    got = collected(H.op12_hard_negatives(spark, SF))
    assert got and got == sorted(duckdb.sql(H.SQL).fetchall(), key=repr)
