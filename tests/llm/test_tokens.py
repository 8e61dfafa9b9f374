import bisect
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from navedge.llm import bpe_chunks, packing, token_store
from navedge.llm.tokens import Encoder

from .data import SF, docs

ALPHABET = ["a", "b", "ab", "The", " ", " ", "\n", "'s", "'ll", "'", "\t", "é", "É", "1", "12", "!", "...", "!!", "<|endoftext|>", "\x1c", "​", "Σ", "ß",
            "\x85", "  ", "\n\n", "﻿", "日本", " 's", "İ", "\x00", "\xa0", "_"]


def fuzz(n, size=14, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, size))) for _ in range(n)]


@pytest.mark.parametrize("name, keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_the_library(name, keeps):
    plain = Tokenizer.from_file(P.path(name))
    plain.encode_special_tokens = True
    texts = fuzz(8000)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in Encoder(P.path(name), keeps, 50)(texts)] == want
    encoder = Encoder(P.path(name), keeps, 50, 300)
    for i in range(0, len(texts), 999):
        ids, sizes = encoder.column(pa.array([None, *texts[i:i + 999]]), 2)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [[2], *(x + [2] for x in want[i:i + 999])]


ROWS = [(7, "some words here"), (3, None), (5, ""), (5, "twice"), (5, "twice"), (None, "no id"), (9, "long text " * 4000), (1, "é!  x\n")]


def library(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text, end: t.encode(text or "", add_special_tokens=False).ids + [end]


def test_token_store_round_trip(spark, tmp_path):
    path, encode = str(tmp_path / "store"), library("byte_bpe_50k.json")
    token_store.write(docs(spark, ROWS), path, token_store.byte_bpe_path(), end_id=2, files=3)
    rows = token_store.read(spark, path)
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(map(tuple, rows.select("doc_id", "ids").collect()), key=repr) == sorted(((i, encode(t, 2)) for i, t in ROWS), key=repr)
    meta = token_store.read_metadata(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in meta] == [i for i, _ in order]
    at = 0
    for r in meta:
        assert r.start == at
        at += r.n_tokens
    crc = {(r.doc_id, r.ids_crc32) for r in token_store.digests(rows).collect()}
    assert crc == {(i, zlib.crc32(np.array(encode(t, 2), "<u4").tobytes())) for i, t in ROWS}
    assert [r.ids for r in token_store.read_tokens(spark, path, [7]).collect()] == [encode("some words here", 2)]


def test_token_store_format(spark, tmp_path):
    import pyarrow.parquet as pq
    path = str(tmp_path / "store")
    token_store.write(docs(spark, ROWS), path, token_store.byte_bpe_path(), end_id=2, files=2)
    files = [pq.ParquetFile(f) for f in sorted((tmp_path / "store").glob("*.parquet"))]
    for f in files:
        for i in range(f.metadata.num_row_groups):
            ids = f.metadata.row_group(i).column(f.schema.names.index("element") if "element" in f.schema.names else 4)
            assert "DELTA_BINARY_PACKED" in ids.encodings and ids.has_offset_index and f.metadata.row_group(i).column(0).has_column_index
    plan = token_store.read(spark, path).drop("ids")._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema")[1]
    token_store.write(docs(spark, []), str(tmp_path / "none"), token_store.byte_bpe_path(), end_id=2, files=2)
    assert token_store.read_metadata(spark, str(tmp_path / "none")).count() == 0


def check_packing(got, rows, encode, capacity):
    want = []
    for i, t in rows:
        ids = encode(t, 0)
        want += [(i, k // capacity, k, len(ids[k:k + capacity]), zlib.crc32(np.array(ids[k:k + capacity], "<u4").tobytes())) for k in range(0, len(ids), capacity)]
    assert sorted((tuple(r[:5]) for r in got), key=repr) == sorted(want, key=repr)
    filled = {}
    for r in got:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(filled)


def test_packing_is_whole_and_gapless(spark):
    encode = library("word_bpe_49k.json")
    rng = random.Random(4)
    rows = ROWS + [(100 + i, "word " * rng.randint(0, 40)) for i in range(400)] + [(900 + i, "same " * 9) for i in range(300)]
    got = packing.pack(docs(spark, rows).repartition(5), packing.word_bpe_path(), capacity=64, keep_ids=True).collect()
    n = check_packing(got, rows, encode, 64)
    assert n <= -(-sum(r.length for r in got) // 64) + 1
    by_doc = {(r.doc_id, r.piece): r.ids for r in got if r.doc_id == 9}
    assert sum((by_doc[9, i] for i in range(len(by_doc))), []) == encode("long text " * 4000, 0)
    assert packing.pack(docs(spark, []), packing.word_bpe_path()).count() == 0


def best_fit(histogram, capacity):
    """Sequences of plain best fit, longest first."""
    gaps = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            i = bisect.bisect_left(gaps, length)
            bisect.insort(gaps, (gaps.pop(i) if i < len(gaps) else capacity) - length)
    return len(gaps)


def test_plan_ends_at_the_least_number(monkeypatch):
    tried, one = [], packing._plan
    monkeypatch.setattr(packing, "_plan", lambda h, c, parts, even: tried.append(parts) or one(h, c, parts, even))
    packing.plan({6: 5, 4: 5}, 10)
    assert tried == [3]
    packing.plan({6: 2}, 10)  # two sequences, not ceil(12 / 10), though ceil is two as well
    packing.plan({6: 3}, 10)  # three, where the bound says two: every plan is tried
    assert tried == [3, 3, 3, 3, 2, 2, 1]
    assert packing.plan({}, 10) == []


def test_plan_uses_exact_complements():
    assert packing.plan({6: 5, 4: 5}, 10) == [(5, (6, 4))]
    assert sorted(packing.plan({7: 2, 2: 2, 1: 2}, 10)) == [(2, (7, 2, 1))]
    assert packing.plan({7: 1, 1: 3}, 10) == [(1, (7, 1, 1, 1))]
    rng = random.Random(2)
    for _ in range(30):
        h = {rng.randint(1, 50): rng.randint(1, 2000) for _ in range(20)}
        patterns = packing.plan(h, 50)
        used = {}
        for n, lengths in patterns:
            assert n > 0 and sum(lengths) <= 50
            for x in lengths:
                used[x] = used.get(x, 0) + n
        assert used == h
        assert sum(n for n, _ in patterns) <= best_fit(h, 50)


def test_chunked_bpe_equals_the_library(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    c = bpe_chunks.Codec(path, P.PATTERN)
    rows = [(i, t) for i, t in enumerate(fuzz(300, 300, 5))] + ROWS + [(9002, "a" * 3000), (9003, " " * 3000), (9005, "x" * 700 + " y" + "z" * 900)]

    def want(i, t):
        ids = c.encoding.encode_ordinary(t or "")
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    for chunk, overlap in ((32, 12), (200, 40)):
        got = bpe_chunks.summaries(docs(spark, rows).repartition(3), path, P.PATTERN, chunk, overlap).collect()
        assert sorted(map(tuple, got), key=repr) == sorted((want(*r) for r in rows), key=repr)
    assert bpe_chunks.summaries(docs(spark, []), path, P.PATTERN).count() == 0


def test_queries_equal_the_libraries(spark):
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    encode, at, want = library("byte_bpe_50k.json"), 0, []
    for i, t in sorted(table):
        ids = encode(t, 2)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, token_store.op2_token_store(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want
    encoding = bpe_chunks.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).encoding
    want = [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
            for i, t in sorted(table) for ids in [encoding.encode_ordinary(t or "")]]
    got = bpe_chunks.op8_byte_bpe(spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == want
    check_packing(packing.op9_packing(spark, SF).collect(), table, library("word_bpe_49k.json"), 2048)
