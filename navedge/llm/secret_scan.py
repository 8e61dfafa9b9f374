"""Secret scans through a trigram inverted index.

From the syntax tree of each rule's regular expression a Boolean query over
trigrams is derived: an AND of ORs that any matching text satisfies. Texts
are indexed in shards, one for each slice of an Arrow batch: the shard's bytes,
in lower case, give all trigram codes at once; those that some rule asks for
become postings (sorted document ordinals of the shard). A rule's query
intersects and unites postings, and only the candidates are verified with the
expression itself. A rule without mandatory trigrams scans every text.

The three base rules come first; the further kinds in ``RULES`` only add
spans. Matches of one kind never overlap; those of different kinds may. A
``private`` span holds the whole key block, not only its BEGIN line; prose is no
part of it.

Defined results: null counts as empty and has no span; a null doc_id stays
null; repeated rows repeat; spans that start together come in the order of
the rules; texts of any length are scanned whole; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, give_back, read_table, slices

#: Alternatives of one literal run that a query spells out at most; beyond it the run ends.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    any_case: bool = False
    #: A match counts if this group has at least so many characters.
    group: int = 0
    least: int = 0

    def regex(self):
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base rules.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", False, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 16),
    Rule("hex", r"[0-9a-f]+", False, 0, 32),
)
# A key block: the BEGIN line, header lines, and the body (long base64 runs, then at most two short ones) with its END line; if that
# is missing, the long runs and the last short ones. Prose between the two lines is no body: then the BEGIN line alone is the span.
# Line ends may be spelled out as \n, as in JSON.
_GAP = r"(?:[\x20\t\r\n]|\\[nr])"
_PRIVATE = (
    r"-----BEGIN (?:(?:RSA |EC |OPENSSH |DSA |ENCRYPTED )?PRIVATE KEY|PGP PRIVATE KEY BLOCK)-----"
    rf"(?:{_GAP}*+(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):[^\r\n\\]*+)*+"
    rf"(?:(?:(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})++(?:{_GAP}*+=?[A-Za-z0-9+/]{{1,15}}={{0,2}}){{0,2}})?{_GAP}*+-----END (?:[A-Z]+ )?PRIVATE KEY(?: BLOCK)?-----"
    rf"|(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})*+(?:[\x20\t\r]*+(?:\n|\\n){_GAP}*+=?[A-Za-z0-9+/]{{1,15}}={{0,2}}(?=[\x20\t]*+(?:[\r\n\"'\\]|\Z))){{0,2}})")
# Public token formats.
FURTHER = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", _PRIVATE),
)
RULES = BASE + FURTHER


# ------------------------------------------------------------------ queries

def trigrams(s: str) -> frozenset[bytes]:
    b = s.lower().encode()
    return frozenset(b[i:i + 3] for i in range(len(b) - 2))


def _literals(tree) -> list[set[str]]:
    """The sequence as runs: each a set of strings, one of which every match holds there.

    A run that ends with None in it is cut off: what follows isn't adjacent.
    """
    runs: list[set[str]] = []
    now = {""}

    def cut():
        nonlocal now
        if now != {""}:
            runs.append(now)
        now = {""}

    def add(options: set[str]):
        nonlocal now
        joined = {a + b for a in now for b in options}
        if len(joined) > MAX_STRINGS:
            cut()
            joined = set(options)
        now = joined

    for op, arg in tree:
        exact = _exact(op, arg)
        if exact is not None and len(exact) <= MAX_STRINGS:
            add(exact)
        elif op is C.SUBPATTERN:
            cut()
            runs += _literals(arg[3])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            cut()
            runs += _literals(arg[2])
        else:
            cut()
    cut()
    return runs


def _exact(op, arg) -> set[str] | None:
    """All strings that the element matches, in lower case, if they are few; else None."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        out: set[str] = set()
        for kind, value in arg:
            if kind is C.LITERAL:
                out.add(chr(value).lower())
            elif kind is C.RANGE and value[1] - value[0] < MAX_STRINGS:
                out |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is C.SUBPATTERN:
        return _exact_all(arg[3])
    if op is C.BRANCH:
        parts = [_exact_all(x) for x in arg[1]]
        return None if any(x is None for x in parts) else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] is not C.MAXREPEAT and arg[1] <= 3:
        once = _exact_all(arg[2])
        if once is None:
            return None
        out, power = set(), {""}
        for n in range(int(arg[1]) + 1):
            if n >= arg[0]:
                out |= power
            power = {a + b for a in power for b in once}
            if len(power) > MAX_STRINGS:
                return None
        return out
    return None


def _exact_all(tree) -> set[str] | None:
    out = {""}
    for op, arg in tree:
        some = _exact(op, arg)
        if some is None or len(out) * len(some) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in some}
    return out


def trigram_query(pattern: str) -> list[list[frozenset[bytes]]]:
    """AND over runs of OR over strings of AND over trigrams; empty if no trigram is mandatory."""
    out = []
    for run in _literals(P.parse(pattern, re.ASCII)):
        if min(map(len, run)) >= 3:
            out.append(sorted({trigrams(s) for s in run}, key=sorted))
    return out


# --------------------------------------------------------------------- index

def code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


def postings(texts: list[bytes], wanted):
    """{code: sorted ordinals of the texts that hold it} for the wanted codes (a Boolean table of 2^24)."""
    import numpy as np

    out: dict[int, object] = {}
    start = 0
    while start < len(texts):  # blocks of bounded size, but for a single text beyond it
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) < 1 << 22):
            size += len(texts[end]) + 2
            end += 1
        joined = np.frombuffer(b"\0\0".join(texts[start:end]).lower() + b"\0\0", np.uint8)
        ends = np.cumsum([len(x) + 2 for x in texts[start:end]])
        wide = joined.astype(np.uint32)
        codes = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
        at = np.flatnonzero(wanted[codes])
        pairs = np.unique(codes[at].astype(np.uint64) << np.uint64(32) | np.searchsorted(ends, at, "right").astype(np.uint64))
        found, first = np.unique(pairs >> np.uint64(32), return_index=True)
        for c, ordinals in zip(found.tolist(), np.split((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64) + start, first[1:])):
            out.setdefault(c, []).append(ordinals)
        start = end
    return {c: np.concatenate(x) for c, x in out.items()}


def candidates(query, index, n: int):
    """Ordinals of the shard's n texts that satisfy the query."""
    import numpy as np

    none = np.empty(0, np.int64)
    out = None
    for run in query:
        options = []
        for string in run:
            lists = sorted((index.get(code(t), none) for t in string), key=len)
            some = lists[0]
            for x in lists[1:]:
                some = np.intersect1d(some, x, assume_unique=True)
            options.append(some)
        some = np.unique(np.concatenate(options))
        out = some if out is None else np.intersect1d(out, some, assume_unique=True)
    return np.arange(n) if out is None else out


def matches(rule: Rule, regex, text: str) -> list[tuple[int, int]]:
    if not rule.group:
        return [(a, b) for a, b in (m.span() for m in regex.finditer(text)) if b - a >= rule.least]
    return [m.span() for m in regex.finditer(text) if len(m.group(rule.group)) >= rule.least]


def find_spans(texts: list[str], rules, prepared) -> list[list[tuple[int, int, str, int]]]:
    """For each text its spans (start, rule number, kind, end), sorted."""
    regexes, queries, wanted = prepared
    index = postings([x.encode("utf-8", "surrogatepass") for x in texts], wanted)
    out: list[list] = [[] for _ in texts]
    for number, (rule, regex, query) in enumerate(zip(rules, regexes, queries)):
        for i in candidates(query, index, len(texts)).tolist():
            out[i] += [(a, number, rule.kind, b) for a, b in matches(rule, regex, texts[i])]
    return [sorted(x) for x in out]


def prepare(rules):
    import numpy as np

    queries = [trigram_query(r.pattern) for r in rules]
    wanted = np.zeros(1 << 24, bool)
    for query in queries:
        for run in query:
            for string in run:
                wanted[[code(t) for t in string]] = True
    return [r.regex() for r in rules], queries, wanted


def _listed(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)


def scan(docs: DataFrame, rules=RULES, base: int = len(BASE)) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans. No shuffle."""

    def run(batches):
        import pyarrow as pa

        prepared = prepare(rules)
        for batch in slices(batches):
            found = find_spans([x or "" for x in batch.column("text").to_pylist()], rules, prepared)
            counts = [[sum(s[1] == k for s in spans) for spans in found] for k in range(base)]
            digests = [hashlib.sha256(_listed(s for s in spans if s[1] < base).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array([_listed(s) for s in found], pa.string())],
                ["doc_id", *(f"n_{r.kind}" for r in rules[:base]), "base_sha256", "spans"])

    bound_batches(docs.sparkSession)
    columns = ", ".join(f"n_{r.kind} long" for r in rules[:base])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, {columns}, base_sha256 string, spans string")


#: Texts that redaction works on together: postings take many times their bytes, and other stages share the worker.
REDACT_BYTES = 1 << 20


def redact(docs: DataFrame, rules=RULES, mark: str = "[secret]") -> DataFrame:
    """All rows and columns of ``docs``; in ``text`` each run of overlapping spans becomes ``mark``.

    Texts without a span, null included, pass unchanged. ``n_chars``, if there, follows the text.
    """
    bound_batches(docs.sparkSession)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        give_back()
        prepared = prepare(rules)
        for batch in slices(batches, most=REDACT_BYTES):
            texts = batch.column(names.index("text")).to_pylist()
            found = find_spans([x or "" for x in texts], rules, prepared)
            texts = [_replaced(t, spans, mark) if spans else t for t, spans in zip(texts, found)]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(texts, pa.string())
            if "n_chars" in names:
                old = batch.column(names.index("n_chars"))
                sizes = [len(t) if s else o for t, s, o in zip(texts, found, old.to_pylist())]
                columns[names.index("n_chars")] = pa.array(sizes, old.type)
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    return docs.mapInArrow(run, docs.schema)


def _replaced(text: str, spans, mark: str) -> str:
    out, at = [], 0
    for a, _, _, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
