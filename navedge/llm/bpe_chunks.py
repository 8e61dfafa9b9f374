"""Byte-level BPE of long texts by overlapping chunks.

A text longer than a chunk is cut into chunks that overlap. Every chunk is
pre-tokenised by itself, in parallel, and reports the boundaries it found in
the two overlaps it shares. Two neighbours resynchronise where both report the
same boundary: from there on they agree, as the pattern looks ahead only. A
boundary counts if no white space stands before it, so that neither side's
tokens depend on what the cut hides, and only if it is a few characters short
of the left chunk's end, whose last tokens may be cut off. The left chunk's
boundaries hold if the chunk itself is synchronised; a boundary before white
space holds in any case, since no pre-token has white space after another
character. Borders without a trusted boundary are not cut: their chunks stay
one piece. The pieces between trusted cuts are encoded one by one and the
ids, in order, are those of the whole text.

Texts of up to one chunk are encoded where they are read. Only chunks are
shuffled, never more than a text's own in one group.

Decoding concatenates the bytes of each id.

Defined results: null and empty texts have no ids and decode to no bytes; a
null doc_id stays null; rows that repeat repeat in the result; empty tables
give empty results; extra columns are not read.
"""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, read_table, slices, staged, write_scratch

#: Characters of a chunk, and of the overlap of neighbours.
CHUNK = 1 << 15
OVERLAP = 512
#: A pre-token's end is sure so many characters before the end of a chunk: contractions look ahead the most.
TAIL = 4


class Codec:
    """Ranks of a file of the tiktoken library, with the pattern that splits a text."""

    def __init__(self, path: str, pattern: str):
        import base64

        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(pattern)
        self.bytes_of = {i: b for b, i in ranks.items()}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        from array import array

        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def decode(self, ids: bytes) -> bytes:
        from array import array

        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))

    def boundaries(self, text: str) -> list[int]:
        """Starts of the pre-tokens."""
        return [m.start() for m in self.words.finditer(text)]


def codec(path: str, pattern: str) -> Codec:
    """One for each Python worker."""
    kept = sys.modules.setdefault("_navedge_codecs", types.ModuleType("_navedge_codecs")).__dict__
    if (path, pattern) not in kept:
        kept[path, pattern] = Codec(path, pattern)
    return kept[path, pattern]


def _summary(c: Codec, ids: bytes) -> tuple[int, str, str]:
    import hashlib

    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()


def chunks_of(text: str, chunk: int, overlap: int) -> list[tuple[int, str]]:
    """(start, text) of the overlapping chunks; the last one reaches the end."""
    step = chunk - overlap
    last = max(0, -(-(len(text) - chunk) // step))
    return [(i * step, text[i * step:i * step + chunk] if i < last else text[i * step:]) for i in range(last + 1)]


def shared_cuts(left: list[int], right: list[int], before_space: list[bool]) -> tuple[int | None, int | None]:
    """(last common boundary, last common boundary before white space), or None."""
    common = set(left)
    found = [(b, s) for b, s in zip(right, before_space) if b in common]
    return (found[-1][0] if found else None), next((b for b, s in reversed(found) if s), None)


def _read_chunks(chunk: int, overlap: int):
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            for row, doc, text in zip(*(batch.column(n).to_pylist() for n in ("row", "doc_id", "text"))):
                parts = chunks_of(text, chunk, overlap)
                for i in range(0, len(parts), 64):
                    some = parts[i:i + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(some), pa.int64()), pa.array([doc] * len(some), pa.int64()),
                         pa.array(range(i, i + len(some)), pa.int32()), pa.array([s for s, _ in some], pa.int64()),
                         pa.array([t for _, t in some], pa.string())], ["row", "doc_id", "chunk_no", "start", "text"])

    return run


def _report(path: str, pattern: str, overlap: int):
    """For each chunk the sure boundaries in its first and last overlap, as positions in the whole text."""

    def run(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        for batch in slices(batches):
            rows = []
            for row, no, start, text in zip(*(batch.column(n).to_pylist() for n in ("row", "chunk_no", "start", "text"))):
                at = [b for b in c.boundaries(text) if b and b <= len(text) - TAIL and not text[b - 1].isspace()]
                head = [b for b in at if b < overlap]
                tail = [b for b in at if b >= len(text) - overlap]
                rows.append((row, no, [start + b for b in head], [text[b].isspace() for b in head], [start + b for b in tail]))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())))],
                ["row", "chunk_no", "head", "head_space", "tail"])

    return run


def _cuts(reports: DataFrame) -> DataFrame:
    """(row, chunk_no, cut): where the chunk takes over from the one before; null if that border isn't trusted."""
    by_text = Window.partitionBy("row").orderBy("chunk_no")
    here = F.arrays_zip("head", "head_space")
    before = F.lag("tail").over(by_text)
    common = F.filter(here, lambda x: F.array_contains(before, x["head"]))
    found = reports.select("row", "chunk_no", common.alias("common"))
    hard = F.filter("common", lambda x: x["head_space"])
    found = found.select("row", "chunk_no", F.get("common", F.size("common") - 1)["head"].alias("any"),
                         F.get(hard, F.size(hard) - 1)["head"].alias("hard"))
    upto = by_text.rowsBetween(Window.unboundedPreceding, 0)
    # The chunk before is synchronised if, since the last chunk that is so by itself, no border failed.
    own = F.max(F.when(F.col("hard").isNotNull() | (F.col("chunk_no") == 0), F.col("chunk_no"))).over(upto)
    failed = F.max(F.when((F.col("chunk_no") > 0) & F.col("any").isNull(), F.col("chunk_no"))).over(upto)
    chained = F.coalesce(failed, F.lit(-1)) < own
    return found.select("row", "chunk_no", F.coalesce("hard", F.when(chained, F.col("any"))).alias("cut"))


def encode_long(texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, ids as bytes) of texts (row, doc_id, text), by chunks; ``row`` is unique."""
    parallel = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = texts.mapInArrow(_read_chunks(chunk, overlap), "row long, doc_id long, chunk_no int, start long, text string")
    parts = staged(parts.repartition(parallel, "row", "chunk_no"), "bpe-chunks")
    reports = parts.mapInArrow(_report(path, pattern, overlap),
                               "row long, chunk_no int, head array<long>, head_space array<boolean>, tail array<long>")
    cuts = staged(_cuts(reports), "bpe-cuts")
    by_text = Window.partitionBy("row").orderBy("chunk_no")
    # A piece runs from a trusted cut to the next; it takes its text from the chunks in between.
    owner = F.max(F.when(F.col("cut").isNotNull() | (F.col("chunk_no") == 0), F.col("chunk_no"))).over(
        by_text.rowsBetween(Window.unboundedPreceding, 0))
    ends = F.lead("cut").over(by_text)
    spans = cuts.select("row", "chunk_no", "cut", ends.alias("next_cut"), owner.alias("piece"))
    joined = parts.join(spans, ["row", "chunk_no"])
    begin = f"coalesce(cut, start + IF(chunk_no = 0, 0, {overlap}))"
    own = joined.select("row", "doc_id", "piece", "chunk_no", F.expr(
        f"substring(text, int({begin} - start + 1), int(coalesce(next_cut, start + length(text)) - {begin}))").alias("text"))
    whole = own.groupBy("row", "doc_id", "piece").agg(F.expr(
        "concat_ws('', transform(array_sort(collect_list(struct(chunk_no, text))), x -> x.text))").alias("text"))

    def run(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        for batch in slices(batches):
            ids = [c.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), batch.column("piece"), pa.array(ids, pa.binary())],
                                             ["row", "doc_id", "piece", "ids"])

    ids = whole.mapInArrow(run, "row long, doc_id long, piece int, ids binary")
    return ids.groupBy("row", "doc_id").agg(F.expr(
        "aggregate(array_sort(collect_list(struct(piece, ids))), X'', (a, x) -> concat(a, x.ids))").alias("ids"))


def summaries(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.length("text") > chunk, F.lit(False))

    def short(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        for batch in slices(batches):
            out = [_summary(c, c.encode(x or "")) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_arrays(out)], _NAMES)

    def long(batches):
        import pyarrow as pa

        c = codec(path, pattern)
        for batch in slices(batches, "ids"):
            out = [_summary(c, x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *_arrays(out)], _NAMES)

    here = rows.where(~is_long).mapInArrow(short, schema)
    # Numbered once, in a written table, so that a number never changes.
    path_of_long = write_scratch(rows.where(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "bpe-long")
    texts = docs.sparkSession.read.schema("row long, doc_id long, text string").parquet(path_of_long)
    ids = encode_long(texts, path, pattern, chunk, overlap)
    return here.unionByName(ids.select("doc_id", "ids").mapInArrow(long, schema))


_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _arrays(out):
    import pyarrow as pa

    columns = list(zip(*out)) or [()] * 3
    return [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())]


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return summaries(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
