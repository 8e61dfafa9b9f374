"""Best-fit packing by exact complements.

A document is its token ids and an end id, cut into pieces only if it is
longer than a sequence. Packing needs piece lengths alone, and there are at
most ``capacity`` of those: the histogram of lengths, which Spark counts, is
all that the driver sees, whatever the number of documents.

The plan works on that histogram. For the longest remaining length, the gap
it leaves is looked up among single lengths, sums of two and sums of three;
each combination found is used as often as the counts allow, so it fills that
many sequences to the last token. Pieces without an exact complement are then
placed best-fit, longest first, again many alike at a time. The result is a
list of patterns (lengths, and how many sequences look so), a few for each
length. Five plans compete: sums up to three, two (each dealt evenly or not)
and one. The one with the fewest sequences is used, so smaller sums stand in
only where they save a sequence; of equal ones the first in that order wins,
and one that reaches the total length divided by the capacity ends the search.

Each piece gets its number among the pieces of its length: encoding tasks
count per length, and a running total over tasks gives each task its start,
so a length that a third of all pieces share is never sorted or gathered.
Number and length lead to the pattern, the sequence and the offset.

Defined results: null text counts as empty and is the end id alone; a null
doc_id is packed like any other; repeated rows are packed each; pieces of
equal length are interchangeable; empty tables give empty results; extra
columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, bound_batches, give_back, read_table, slices, staged
from .tokens import TOGETHER_BYTES, together, worker_encoder

CAPACITY = 2048


# --------------------------------------------------------------------- pieces

def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, keeps_spaces: bool = False,
           keep_ids: bool = False, work_bytes: int = TOGETHER_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task, number (among its length in the task)[, ids].

    ``work_bytes``: texts that are encoded together; arrays of several times their size stand in memory.
    """

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, task = worker_encoder(tokenizer_path, keeps_spaces), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        if work_bytes < TOGETHER_BYTES:
            give_back()
        for doc_ids, texts in together(slices(batches, most=min(work_bytes, SLICE_BYTES)), work_bytes):
            ids, sizes = encode.column(texts, end_id)
            ends, rows = np.cumsum(sizes).tolist(), []
            for doc, begin, stop in zip(doc_ids.to_pylist(), [0, *ends], ends):
                packed = ids[begin:stop].tobytes()
                for i, at in enumerate(range(0, len(packed), 4 * capacity)):
                    some = packed[at:at + 4 * capacity]
                    n = len(some) // 4
                    rows.append((doc, i, at // 4, n, zlib.crc32(some), int(seen[n]), some))
                    seen[n] += 1
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            out = [pa.array(c, t) for c, t in zip(columns, types)]
            out.insert(5, pa.array([task] * len(rows), pa.int32()))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
            if keep_ids:
                values = np.frombuffer(b"".join(columns[6]), "<i4")
                ends = np.concatenate(([0], np.cumsum(np.array(columns[3], np.int32)))).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, schema + (", ids array<int>" if keep_ids else ""))


# ----------------------------------------------------------------------- plan

class _Sums:
    """Pairs of available lengths by their sum; a sum that has none stays without, as counts only fall."""

    def __init__(self, counts, even: bool):
        self.counts, self.even, self.known, self.none = counts, even, {}, set()

    def _ok(self, a: int, b: int) -> bool:
        return self.counts[a] > (a == b) and self.counts[b] > 0

    def pair(self, total: int):
        import numpy as np

        if total in self.none or total < 2:
            return None
        if (pair := self.known.get(total)) and self._ok(*pair):
            return pair
        low = np.arange(1, total // 2 + 1)
        ok = (self.counts[low] > (2 * low == total)) & (self.counts[total - low] > 0)
        if not ok.any():
            self.none.add(total)
            return None
        a = int(low[ok][-1 if self.even else 0])  # else with the longest partner
        self.known[total] = (total - a, a)
        return self.known[total]

    def triple(self, total: int):
        import numpy as np

        for a in np.flatnonzero(self.counts[:max(0, total - 1)])[::-1].tolist():
            self.counts[a] -= 1
            rest = self.pair_now(total - a)
            self.counts[a] += 1
            if rest:
                return (a, *rest)
        return None

    def pair_now(self, total: int):
        """As ``pair``, while one length is set aside: absence isn't noted."""
        missing = total in self.none
        found = self.pair(total)
        if not missing and not found:
            self.none.discard(total)
        return found


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(sequences, lengths in each) that use up the histogram: the best of complements of up to three, two
    and one length, with even or uneven pairs, as filling early can leave the rest without small pieces.
    The first plan that reaches the least possible number ends the search."""
    least, best, fewest = -(-sum(length * n for length, n in histogram.items()) // capacity), [], None
    for parts, even in ((3, True), (3, False), (2, True), (2, False), (1, False)):
        found = _plan(histogram, capacity, parts, even)
        n = sum(k for k, _ in found)
        if fewest is None or n < fewest:
            best, fewest = found, n
        if fewest == least:
            break
    return best


def _plan(histogram: dict[int, int], capacity: int, parts: int, even: bool) -> list[tuple[int, tuple[int, ...]]]:
    import numpy as np

    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    out: list[tuple[int, tuple[int, ...]]] = []

    def use(pattern: tuple[int, ...]) -> None:
        lengths, times = np.unique(pattern, return_counts=True)
        n = int((counts[lengths] // times).min())
        counts[lengths] -= n * times
        out.append((n, tuple(sorted(pattern, reverse=True))))

    if counts[capacity]:
        use((capacity,))
    sums = _Sums(counts, even)
    for length in range(capacity - 1, 0, -1):
        gap = capacity - length
        while counts[length]:
            counts[length] -= 1
            rest = (gap,) if counts[gap] else parts > 1 and sums.pair_now(gap) or parts > 2 and sums.triple(gap)
            counts[length] += 1
            if not rest:
                break
            use((length, *rest))
    # What has no exact complement: best fit, longest first. Open sequences by the gap they have left.
    still: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            gap = next((g for g in range(length, capacity) if still.get(g)), None)
            if gap is None:
                each = capacity // length
                for n, k in ((left // each, each), (left % each and 1, left % each)):
                    if n:
                        still.setdefault(capacity - k * length, []).append([n, (length,) * k])
                left = 0
                continue
            group = still[gap][-1]
            n = min(left, group[0])
            still.setdefault(gap - length, []).append([n, (*group[1], length)])
            group[0] -= n
            if not group[0]:
                still[gap].remove(group)
            left -= n
    return out + [(n, lengths) for groups in still.values() for n, lengths in groups if n]


def slots(patterns) -> dict[int, tuple[list[int], list[tuple[int, int, int, int]]]]:
    """length -> (first numbers, (first sequence, first number, pieces a sequence, first offset))."""
    out: dict[int, tuple[list[int], list]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for n, lengths in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            k = lengths.count(length)
            starts, rows = out.setdefault(length, ([], []))
            starts.append(used.get(length, 0))
            rows.append((sequence, starts[-1], k, offset))
            used[length] = starts[-1] + n * k
            offset += k * length
        sequence += n
    return out


def placed(by_length, length: int, number: int) -> tuple[int, int]:
    """(sequence, offset) of the piece with that number among those of its length."""
    starts, rows = by_length[length]
    sequence, first, k, offset = rows[bisect_right(starts, number) - 1]
    number -= first
    return sequence + number // k, offset + number % k * length


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, keeps_spaces: bool = False,
         keep_ids: bool = False, work_bytes: int = TOGETHER_BYTES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]."""
    bound_batches(docs.sparkSession)
    found = staged(pieces(docs, tokenizer_path, end_id, capacity, keeps_spaces, keep_ids, work_bytes), "pieces")
    by_task = staged(found.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # At most ``capacity`` rows.
    histogram = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    by_length = slots(plan(histogram, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = found.join(first, ["length", "task"]).withColumn("number", F.col("number") + F.col("first"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = numbered.select(*names, "number", *(["ids"] if keep_ids else []))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            at = [placed(by_length, a, b) for a, b in zip(batch.column("length").to_pylist(), batch.column("number").to_pylist())]
            out = [*(batch.column(n) for n in names), pa.array([x for x, _ in at], pa.int64()), pa.array([y for _, y in at], pa.int64())]
            if keep_ids:
                out.append(batch.column("ids"))
            yield pa.RecordBatch.from_arrays(out, [*names, "sequence_id", "offset", *(["ids"] if keep_ids else [])])

    return numbered.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
                               + (", ids array<int>" if keep_ids else ""))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), word_bpe_path())
