"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Items (questions with their answers) are normalised to words and cut into
windows of ten consecutive words; an item of fewer words is one window. The
windows, as sequences of word numbers, make one automaton. Every text is
normalised the same way and scanned once: words that no item holds lead back
to the root, and every occurrence of every window is reported, wherever it
overlaps another. Normalisation replaces bytes one by one, so a word's place
in the normalised text is its place in the original, and hits are returned as
code point spans of the original text.

The scan is a map pass without a shuffle. The windows are counted first: up to
``AUTOMATON_WINDOWS`` they are sent to the tasks as one automaton; a larger
suite is dealt over several automata by hash, and the documents pass them one
after another, each pass adding its hits to those before.

Defined results: null or blank text has no words and is clean; items without
words are never found; repeated items count once, and an item_id on several
texts is one item that is found if any of its texts is; a null item_id counts
as one more item and prints as ``null``; repeated documents give repeated
rows; empty tables give empty results (or clean documents); other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, read_table, slices, staged

WINDOW = 10
#: Windows of one automaton (at most ten nodes each, about 100 MB in a worker).
AUTOMATON_WINDOWS = 200_000
#: Windows of one piece of a long item.
PIECE_WINDOWS = 1000

#: Bytes of a word: digits, letters and all that is not ASCII; A-Z become a-z, the rest blanks.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def pieces(items: DataFrame, window: int = WINDOW, size: int = PIECE_WINDOWS) -> DataFrame:
    """(item_id, words, n): distinct runs of at most ``size`` windows of each item, blank-joined; ``n`` windows each."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            ids, runs, n = [], [], []
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                windows = max(1, len(words) - window + 1) if words else 0
                for a in range(0, windows, size):
                    ids.append(item_id)
                    runs.append(b" ".join(words[a:a + size + window - 1]))
                    n.append(min(size, windows - a))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(runs, pa.binary()), pa.array(n, pa.int64())], ["item_id", "words", "n"])

    return (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
            .mapInArrow(run, "item_id long, words binary, n long").distinct())


class Automaton:
    """Aho-Corasick automaton over word numbers; built where it is used."""

    def __init__(self, rows, window: int):
        import ahocorasick
        import numpy as np

        self.number: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in rows}, key=lambda i: (i is None, i))
        place = {i: p for p, i in enumerate(self.items)}
        holders: dict[tuple, set] = {}
        for item_id, run in rows:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in run.split()]
            k = min(window, len(ids))
            for a in range(len(ids) - k + 1):
                holders.setdefault(tuple(ids[a:a + k]), set()).add(place[item_id])
        self.holders = [sorted(h) for h in holders.values()]
        self.lengths = np.array([len(w) for w in holders], np.int64)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for at, w in enumerate(holders):
            self.machine.add_word(w, at)
        if holders:
            self.machine.make_automaton()

    def scan(self, words: list[bytes]):
        """(mask of words inside occurrences, places of the items found); None if nothing is found."""
        import itertools

        import numpy as np

        if not self.holders or not words:
            return None
        found = list(self.machine.iter(tuple(map(self.number.get, words, itertools.repeat(0)))))
        if not found:
            return None
        ends, which = np.array(found, np.int64).T
        n = len(words)
        change = np.bincount(ends - self.lengths[which] + 1, minlength=n + 1) - np.bincount(ends + 1, minlength=n + 1)
        return np.cumsum(change[:n]) > 0, {p for w in set(which.tolist()) for p in self.holders[w]}


def spans_of(text: str, hit) -> list[dict]:
    """Code point spans, end exclusive, of the runs of hit words in the original text."""
    import numpy as np

    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.frombuffer(raw.tobytes().translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    run = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    first, last = np.flatnonzero(run == 1), np.flatnonzero(run == -1) - 1
    return [{"start": a, "end": b} for a, b in zip(points[starts[first]].tolist(), points[ends[last]].tolist())]


_STATE = "doc_id long, text string, hit binary, items array<long>"
_RESULT = "doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start: long, end: long>>"


def _pass(rows, window: int, last: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        machine = Automaton(rows, window)
        listed = pa.list_(pa.int64())
        for batch in slices(batches):
            made = []
            before = zip(*(batch.column(c).to_pylist() if c in batch.schema.names else [None] * batch.num_rows for c in ("hit", "items")))
            for text, (bits, items) in zip(batch.column("text").to_pylist(), before):
                words = words_of(text)
                mask = None if bits is None else np.unpackbits(np.frombuffer(bits, np.uint8), count=len(words)).astype(bool)
                if (got := machine.scan(words)) is not None:
                    mask = got[0] if mask is None else mask | got[0]
                    items = sorted({*(items or []), *(machine.items[p] for p in got[1])}, key=lambda i: (i is None, i))
                if last:
                    made.append((len(words), 0 if mask is None else int(mask.sum()), items or [], [] if mask is None else spans_of(text, mask)))
                else:
                    made.append((None if mask is None else np.packbits(mask).tobytes(), items))
            columns = [list(c) for c in zip(*made)]
            if last:
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                out = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], listed), pa.array(columns[3], span)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], ["doc_id", "n_words", "n_hit", "items", "spans"])
            else:
                out = [batch.column("text"), pa.array(columns[0], pa.binary()), pa.array(columns[1], listed)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], ["doc_id", "text", "hit", "items"])

    return run


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, most: int = AUTOMATON_WINDOWS) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, items (found, ascending), spans (hit runs in the original text)."""
    bound_batches(docs.sparkSession)
    cut = staged(pieces(items, window), "decontaminate-items")
    machines = -(-(cut.agg(F.sum("n")).first()[0] or 0) // most) or 1
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for m in range(machines):
        mine = cut.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(machines)) == m)
        rows = [(i, bytes(w)) for i, w in mine.select("item_id", "words").collect()]  # about ``most`` windows
        last = m == machines - 1
        state = state.mapInArrow(_pass(rows, window, last), _RESULT if last else _STATE)
        state = state if last else staged(state, "decontaminate-pass")
    return state


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: F.coalesce(i.cast("string"), F.lit("null"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The same in DuckDB: windows of items joined to windows of texts of the same lengths.
SQL = f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
     cut AS (SELECT item_id, w, least({WINDOW}, len(w)) AS k, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i FROM items WHERE len(w) > 0),
     wanted AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM cut),
     lengths AS (SELECT DISTINCT k FROM wanted),
     docs AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS} AS w FROM documents),
     places AS (SELECT rn, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, lengths WHERE len(w) >= k),
     found AS (SELECT p.rn, p.i, p.k, v.item_id FROM places p JOIN wanted v ON p.k = v.k AND array_to_string(p.w[p.i:p.i + p.k - 1], ' ') = v.win),
     hits AS (SELECT rn, count(DISTINCT word) AS n_hit FROM (SELECT rn, unnest(range(i, i + k)) AS word FROM found) GROUP BY rn),
     named AS (SELECT rn, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
               FROM (SELECT DISTINCT rn, coalesce(item_id::VARCHAR, 'null') AS id FROM found) GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (rn) LEFT JOIN named USING (rn)
"""
