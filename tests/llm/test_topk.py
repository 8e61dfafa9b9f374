import math
import random

import duckdb
import numpy as np

from navedge.llm import topk as X

from .data import SF, collected, with_extra

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    v = [(i, a, [math.floor(256 * x) for x in e]) for i, (a, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, a, e in v:
        if a is not None and a % every == 0:
            best = sorted(((-sum(x * y for x, y in zip(e, f)), b is None, b or 0, b) for j, b, f in v if j != i), key=lambda z: z[:3])[:k]
            out += [(a, rank, z[3], -z[0]) for rank, z in enumerate(best, 1)]
    return sorted(out, key=repr)


def test_ties_nulls_repeats_and_ragged_rows(spark):
    rng = random.Random(2)
    odd = [None, [None, 1.0], [float("nan"), 0.5], [float("inf")], []]
    rows = [(rng.randint(0, 150) if rng.random() > 0.05 else None,
             rng.choice(odd) if rng.random() < 0.1 else [rng.choice([0.5, -0.5, 1.0, 3.0, 0.125]) for _ in range(rng.choice([3, 4]))]) for _ in range(300)]
    rows += [(50, [0.5, 0.5, 0.5])] * 90
    got = X.search(with_extra(spark, rows, SCHEMA).repartition(4), 5, 50, block=16, queries=3)
    assert collected(got) == brute(rows, 5, 50)


def test_lengths_and_directions_prune(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) * (2.0 ** -np.arange(12)) * rng.choice([0.1, 1, 8], size=(400, 1))
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    assert collected(X.search(spark.createDataFrame(rows, SCHEMA), 5, 20, block=32, queries=8)) == brute(rows, 5, 20)
    turned = np.floor(256 * x) @ np.linalg.svd(np.floor(256 * x))[2].T
    floors = np.full(10, 3e6)
    qs, xs = X.chances(turned[:10], turned, floors, [3, 6])
    alive = turned[:10] @ turned.T >= 3e6
    assert set(np.flatnonzero(alive.any(axis=1))) <= set(qs) and set(np.flatnonzero(alive.any(axis=0))) <= set(xs) and len(xs) < 400


def test_large_components_stay_exact():
    q, x = np.array([[1 << 30, 3]], float), np.array([[1 << 30, 1], [(1 << 30) - 1, 5]], float)
    assert X.whole_scores(q, x).tolist() == [[(1 << 60) + 3, (1 << 60) - (1 << 30) + 15]]


def test_components_beyond_long(spark):
    from navedge.llm.vectors import MOST
    rows = [(0, [1e17, 1.0]), (50, [2.0 ** 31, 2.0 ** 31]), (3, [1.0, 0.5]), (4, [0.25, 7.0]), (5, [-1e300, 2.0]), (6, [1e308, 1e308]), (7, [1e150, 1e150]),
            (100, [0.1, 0.2])]
    kept = [r for r in rows if math.isfinite(256 * max(map(abs, r[1])))]
    want = sorted(((a, rank, b, max(-MOST, min(MOST, s))) for a, rank, b, s in clamped(kept)), key=repr)
    assert collected(X.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50, block=2, queries=1)) == want


def clamped(rows):
    from navedge.llm.vectors import MOST
    v = [(a, [math.floor(256 * x) for x in e]) for a, e in rows]
    for a, e in v:
        if a % 50 == 0:
            best = sorted((-max(-MOST, min(MOST, sum(x * y for x, y in zip(e, f)))), b) for b, f in v if b != a)[:5]
            yield from ((a, rank, b, -s) for rank, (s, b) in enumerate(best, 1))


def test_short_vectors_are_not_sent(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(640, 4)) * np.repeat([64.0, 1.0], 320)[:, None] / 64
    rows = [(i if i < 320 else i + 1000, [float(v) for v in r]) for i, r in enumerate(x)]
    sent = {}
    kept = X.staged
    monkeypatch.setattr(X, "staged", lambda df, name, *a, **k: sent.setdefault(name, kept(df, name, *a, **k)))
    rows = [(i + 1 if i % 50 == 0 and i > 300 else i, v) for i, v in rows]  # queries are long ones
    got = collected(X.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5, 50, block=32, queries=8))
    assert got == brute(rows, 5, 50) and sent["topk-pairs"].count() < sent["topk-blocks"].count() * sent["topk-queries"].count() * 0.75


def test_few_or_no_rows(spark):
    assert X.search(with_extra(spark, [], SCHEMA), 5, 50).count() == 0
    assert X.search(with_extra(spark, [(50, None)], SCHEMA), 5, 50).count() == 0
    assert collected(X.search(with_extra(spark, [(50, [1.0]), (1, [2.0])], SCHEMA), 5, 50)) == [(50, 1, 1, 256 * 512)]


def test_query_equals_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS FROM '{SF}/embeddings.parquet'")
    assert collected(X.op6_topk(spark, SF)) == sorted(duckdb.sql(X.SQL).fetchall(), key=repr)
