import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from navedge.llm import prefix_trie as P

from .data import SF, collected, with_extra

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    digest = lambda r, t: hashlib.md5((f"{len(r)}:{r}{t}").encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[3] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()), key=repr)


def cases(seed, convs=160, turns=9):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-40, convs), 250, 301, 302]:
        if c == 100:
            continue  # a block without its first conversation
        for t in range(rng.choice([0, 1, 2, 4, turns])):
            rows.append((c, t if rng.random() > 0.05 else None, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bé😀", "", None, "ab"])))
    rows += [(7, 1, "user", "a")] * 3 + [(None, 1, "user", "a"), (400, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture
def small(monkeypatch):
    """Shards, slabs and lists so small that everything crosses them."""
    def use(**sizes):
        for name, size in sizes.items():
            monkeypatch.setattr(P, name, size)
    return use


def test_equals_brute_force(spark):
    rows = cases(1)
    assert collected(P.nodes(with_extra(spark, rows, SCHEMA).repartition(3))) == brute(rows)


def test_shards_recombine(spark, small):
    small(SHARD_ROWS=5, SHARD_CELLS=30, ENDS_PIECE=2)
    rows = cases(2)
    # a third of all rows are copies of one conversation
    rows += [(c, t, "user", f"copy {t}") for c in range(500, 600) for t in range(6)]
    assert collected(P.nodes(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_slabs_of_long_conversations(spark, small):
    small(SLAB=8, SHARD_ROWS=7, SHARD_CELLS=60)
    rows = cases(3, 60, 19)
    rows += [(c, t, "user", f"shared {t}" if t < 40 - 3 * (c % 4) else f"own {c} {t}") for c in range(700, 712) for t in range(45)]
    rows += [(900, t, "user", "alone") for t in range(120)] + [(901, t, "user", "alone") for t in range(24)]
    rows += [(902 + i, t, "assistant", "exact") for i in range(3) for t in range(16)]
    assert collected(P.nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = cases(4, 30) + [(3, t, "user", f"t{t % 7}") for t in range(400)]
    assert collected(P.nodes(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


def test_empty_tables(spark):
    assert P.nodes(with_extra(spark, [], SCHEMA)).count() == 0
    assert P.nodes(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    one = [(1, 0, "user", "x")]
    assert collected(P.nodes(spark.createDataFrame(one, SCHEMA))) == brute(one)


def test_query_equals_sql_and_brute_force(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW conversations AS FROM '{SF}/conversations.parquet'")
    got = collected(P.op11_prefix_trie(spark, SF))
    assert got == sorted(duckdb.sql(P.SQL).fetchall(), key=repr)
    assert got == brute(duckdb.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())
