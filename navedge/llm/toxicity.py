"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers over word classes are composed once into a single
table. Each reads the classes that the one before writes:

* negation marks insults and threats that follow a negator within three words;
* reported speech marks those in a clause after a verb of saying;
* target marks those in a clause that has named a person before;
* insult and threat turn the marked classes into matches with a factor.

A match is a *clause* match if the grammar found a whole pattern, an insult
after its target or a threat, neither negated nor reported; it is *softened* if
one of these stands before it; an insult that nobody is the target of is a
*lone* word. A clause is the text between sentence marks, semicolons or line
ends; states start anew with each clause, and its weight of a kind is the sum
of word weight times factor over its matches of that kind. Logistic regression
weighs, apart from each other, the total and the heaviest clause of the whole
patterns and of the lone words, and the total of the softened ones: how much a
lone word says is what the labels say about it.

Word weights come from labelled documents: log odds of a word's contexts (the
distinct words before it, so that copies of a text count once) in toxic
against clean documents, kept if chance is unlikely to give as many. Fixed
words stay in the grammar with a prior weight until labels speak against them.

Only the fit reads labels, over at most ``MAX_LABELLED`` rows (chosen by a
hash of doc_id); every word that passes the test is learned. Scoring reads
every whole text and no other column.

Defined results: null and empty texts have no clause and get the model's
lowest score; a null doc_id is scored, is never labelled and counts as
not held out; repeated labelled rows repeat in the result, and a document with
conflicting labels counts once for each; without labels of both kinds the
fixed words and coefficients are used; extra columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import bound_batches, give_back, read_table, sheltered, slices, staged

#: Labelled documents that a fit reads at most.
MAX_LABELLED = 20_000
#: A learned word has at least so many contexts and, by chance, no equal in a vocabulary of this kind.
MIN_CONTEXTS = 3
CHANCE = 0.05
PRIOR_WEIGHT = 2.0
WEIGHT_RANGE = (0.5, 6.0)
#: Kinds of matches, and the features: log of 1 + total weight, and greatest clause weight.
KINDS = ("clause", "lone", "soft")
FEATURES = (("clause", "total"), ("clause", "greatest"), ("lone", "total"), ("lone", "greatest"), ("soft", "total"))
#: Coefficients without labels: intercept, then one a feature.
DEFAULT_FIT = (-4.0, 2.0, 1.5, 1.0, 0.5, 0.0)

# The words of the classes.
INSULTS = ("idiot idiots moron morons stupid dumb loser losers scum trash worthless pathetic disgusting clown fool fools "
           "imbecile cretin vermin filth filthy ugly retard bastard bitch coward pig").split()
THREATS = "kill murder strangle stab shoot lynch rape destroy hurt beat burn hang exterminate".split()
TARGETS = "you your yours u he him his she her they them their we us this these those".split()
NEGATORS = "not no never neither nor without isn't aren't wasn't don't doesn't cannot can't nicht kein pas jamais nunca".split()
REPORTS = "said says say called calls claimed claims wrote writes quoted quote reported reports according accused accuses".split()

FRAMES = frozenset((*TARGETS, *NEGATORS, *REPORTS))

_WORD = re.compile(r"[\w']+|[.!?;\n]+")
_MARK = re.compile(r"[.!?;\n]")


# ------------------------------------------------------------------ grammar

def negation_fst(scope: int = 3) -> dict:
    """(state, class) -> (state, class, factor); the state counts words left in the negator's scope."""
    arcs = {}
    for s in range(scope + 1):
        after = max(0, s - 1)
        for c in ("other", "target", "report"):
            arcs[s, c] = (after, c, 1.0)
        arcs[s, "neg"] = (scope, "other", 1.0)
        for c in ("insult", "threat"):
            arcs[s, c] = (after, "neg_" + c if s else c, 1.0)
    return arcs


def reported_fst() -> dict:
    arcs = {}
    for s in (0, 1):
        for c in ("other", "target"):
            arcs[s, c] = (s, c, 1.0)
        arcs[s, "report"] = (1, "other", 1.0)
        for c in ("insult", "threat"):
            arcs[s, c] = (s, "said_" + c if s else c, 0.5 if s else 1.0)
            arcs[s, "neg_" + c] = (s, "neg_" + c, 0.5 if s else 1.0)
    return arcs


def target_fst() -> dict:
    arcs = {}
    for s in (0, 1):
        arcs[s, "other"] = (s, "other", 1.0)
        arcs[s, "target"] = (1, "other", 1.0)
        arcs[s, "insult"] = (s, "aimed_insult" if s else "insult", 1.5 if s else 1.0)
        for c in ("threat", "neg_insult", "neg_threat", "said_insult", "said_threat"):
            arcs[s, c] = (s, c, 1.5 if s else 1.0)
    return arcs


_THREATS_ON = ("threat", "neg_threat", "said_threat")


def insult_fst() -> dict:
    arcs = {(0, "other"): (0, "other", 1.0), (0, "aimed_insult"): (0, "clause", 1.0), (0, "insult"): (0, "lone", 1.0),
            (0, "neg_insult"): (0, "soft", 0.25), (0, "said_insult"): (0, "soft", 1.0)}
    return arcs | {(0, c): (0, c, 1.0) for c in _THREATS_ON}


def threat_fst() -> dict:
    arcs = {(0, c): (0, c, 1.0) for c in ("other", *KINDS)}
    return arcs | {(0, "threat"): (0, "clause", 1.25), (0, "neg_threat"): (0, "soft", 0.25), (0, "said_threat"): (0, "soft", 1.25)}


def compose(first: dict, second: dict) -> dict:
    """The transducer that feeds the output of ``first`` to ``second``; factors multiply. Start states are 0."""
    symbols = sorted({c for _, c in first})
    arcs, todo, names = {}, [(0, 0)], {(0, 0): 0}
    while todo:
        a, b = todo.pop()
        for c in symbols:
            if (a, c) not in first:
                continue
            a2, mid, w1 = first[a, c]
            if (b, mid) not in second:
                continue
            b2, out, w2 = second[b, mid]
            if (a2, b2) not in names:
                names[a2, b2] = len(names)
                todo.append((a2, b2))
            arcs[names[a, b], c] = (names[a2, b2], out, w1 * w2)
    return arcs


def parts() -> list[dict]:
    return [negation_fst(), reported_fst(), target_fst(), insult_fst(), threat_fst()]


def grammar() -> dict:
    first, *rest = parts()
    for part in rest:
        first = compose(first, part)
    return first


def lexicon(learned: dict[str, float], spoken_against: set[str] = frozenset()) -> dict[str, tuple[str, float]]:
    """word -> (class, weight)."""
    out: dict[str, tuple[str, float]] = {}
    for words, kind in ((REPORTS, "report"), (TARGETS, "target"), (NEGATORS, "neg")):
        out |= {w: (kind, 0.0) for w in words}
    for words, kind in ((THREATS, "threat"), (INSULTS, "insult")):
        out |= {w: (kind, PRIOR_WEIGHT) for w in words if w not in spoken_against}
    for w, weight in learned.items():
        if w not in FRAMES:  # the grammar's own words keep their class
            out[w] = ("threat" if w in THREATS else "insult", weight)
    return out


def clause_weights(text: str, words: dict, hits: frozenset, arcs: dict) -> list[tuple[float, float, float]]:
    """Weights by kind (``KINDS``) of the clauses that the grammar matches."""
    tokens = _WORD.findall(text.lower())
    if hits.isdisjoint(tokens):
        return []
    out, state, total, place = [], 0, [0.0, 0.0, 0.0], {k: i for i, k in enumerate(KINDS)}
    for t in tokens:
        if t in words:
            kind, weight = words[t]
        elif _MARK.match(t):
            if any(total):
                out.append(tuple(total))
                total = [0.0, 0.0, 0.0]
            state = 0
            continue
        else:
            kind, weight = "other", 0.0
        state, symbol, factor = arcs[state, kind]
        if symbol != "other":
            total[place[symbol]] += weight * factor
    return [*out, tuple(total)] if any(total) else out


def features(weights: list[tuple[float, float, float]]) -> tuple[float, ...]:
    """A document's features, as ``FEATURES`` names them."""
    of = {k: [w[i] for w in weights] for i, k in enumerate(KINDS)}
    return tuple(math.log1p(sum(of[k])) if what == "total" else max(of[k], default=0.0) for k, what in FEATURES)


# ---------------------------------------------------------------------- fit

def _labelled(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """Texts and labels of a bounded sample, chosen by a hash of doc_id."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(cast(doc_id AS string)) % 5 <> 0").distinct()
              .orderBy(F.xxhash64("doc_id"), "toxic").limit(max_labelled))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most max_labelled narrow rows are broadcast.
    return texts.join(F.broadcast(staged(chosen, "toxic-labels")), "doc_id").where("text IS NOT NULL").select("text", "toxic")


def _binomial_tail(k, n, p: float):
    """Chance of k or more of n, bounded by Chernoff's inequality; both columns."""
    share = k / n
    left = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - p))).otherwise(0.0)
    return F.when(share <= p, 1.0).otherwise(F.exp(-n * (share * F.log(share / p) + left)))


def learn_words(sample: DataFrame) -> tuple[dict[str, float], set[str]]:
    """Weights of words that mark toxic texts; fixed words that labels speak against."""
    words = F.filter(F.split(F.lower("text"), r"(?U)[^\w']+"), lambda w: F.length(w) > 0)
    pairs = (sample.select("toxic", words.alias("w"))
             .select("toxic", F.posexplode("w").alias("i", "word"), "w")
             .select("toxic", "word", F.xxhash64(F.get("w", F.col("i") - 1)).alias("before")))
    contexts = pairs.groupBy("word", "before").agg(F.max("toxic").alias("bad"), F.max(1 - F.col("toxic")).alias("good"))
    counts = staged(contexts.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "toxic-words")
    size, bad, good = counts.where(f"bad + good >= {MIN_CONTEXTS}").agg(F.count(F.lit(1)), F.sum("bad"), F.sum("good")).first()
    if not bad or not good:
        return {}, set()
    base = bad / (bad + good)
    fixed = set(INSULTS) | set(THREATS)
    both = F.col("bad") + F.col("good")
    likely = counts.where((F.col("bad") >= MIN_CONTEXTS) & (F.col("bad") / both >= (1 + base) / 2)
                          & (_binomial_tail(F.col("bad"), both, base) * size < CHANCE))
    learned: dict[str, float] = {}
    for word, b, g in likely.collect():  # words that pass the test, of at most max_labelled texts
        odds = math.log((b + 0.5) / (g + 0.5)) - math.log(bad / good)
        learned[word] = min(max(odds, WEIGHT_RANGE[0]), WEIGHT_RANGE[1])
    against = {w for w, b, g in counts.where(F.col("word").isin(sorted(fixed))).collect()
               if b + g >= MIN_CONTEXTS and b / (b + g) <= base}
    return learned, against - learned.keys()


def _score_pass(model_words, arcs, coefficients):
    hits = frozenset(w for w, (kind, _) in model_words.items() if kind in ("insult", "threat"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices(batches):
            rows = [features(clause_weights(x or "", model_words, hits, arcs)) for x in batch.column("text").to_pylist()]
            x = np.array(rows, dtype=float).reshape(-1, len(FEATURES))
            if coefficients is None:
                yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c) for c in x.T)], ["toxic", *(f"f{i}" for i in range(x.shape[1]))])
            else:
                z = coefficients[0] + x @ np.array(coefficients[1:])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))],
                                                 [*batch.schema.names, "score"])

    return run


def _logistic(x, y, ridge: float = 1e-2, steps: int = 50):
    """Newton's method; coefficients of a column of ones and of x."""
    import numpy as np

    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[dict, tuple]:
    """(lexicon, coefficients) from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    import numpy as np

    bound_batches(docs.sparkSession)
    sample = staged(_labelled(docs, labels, max_labelled), "toxic-sample")
    learned, against = learn_words(sample)
    words, arcs = lexicon(learned, against), grammar()
    # At most max_labelled rows of a few numbers.
    names = [f"f{i}" for i in range(len(FEATURES))]
    rows = sample.mapInArrow(_score_pass(words, arcs, None), ", ".join(["toxic int", *(f"{n} double" for n in names)])).toPandas()
    y = rows["toxic"].to_numpy(dtype=float)
    if len(set(y)) < 2:
        return words, DEFAULT_FIT
    return words, _logistic(np.ascontiguousarray(rows[names].to_numpy()), y)


def score(docs: DataFrame, model: tuple[dict, tuple]) -> DataFrame:
    """(doc_id, text, score) of every row; no shuffle."""
    words, coefficients = model
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_pass(words, grammar(), coefficients), "doc_id long, text string, score double")


def held_out_auc(docs: DataFrame, labels: DataFrame, model: tuple[dict, tuple]) -> dict[str, float]:
    """Area under the curve over held-out labelled rows: of the score, of each feature alone, and of the greatest word
    weight anywhere in the text, which needs no grammar."""
    words, coefficients = model
    hits = frozenset(w for w, (kind, _) in words.items() if kind in ("insult", "threat"))
    arcs = grammar()

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches):
            rows = []
            for x in batch.column("text").to_pylist():
                f = features(clause_weights(x or "", words, hits, arcs))
                word = max((words[t][1] for t in _WORD.findall((x or "").lower()) if t in hits), default=0.0)
                rows.append((coefficients[0] + sum(a * b for a, b in zip(coefficients[1:], f)), *f, word))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(c, pa.float64()) for c in zip(*rows))], ["toxic", *names])

    names = ["score", *(f"{k}_{what}" for k, what in FEATURES), "greatest_word"]
    asked = docs.join(labels.where("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic")), "doc_id").where(held_out(F.col("doc_id")))
    found = asked.select("toxic", "text").mapInArrow(run, ", ".join(["toxic int", *(f"{n} double" for n in names)]))
    out = {}
    for n in names:  # ranks of equal values are their mean: from counts by value, below and equal
        by = found.groupBy(n).agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        below = F.sum("good").over(Window.orderBy(n).rowsBetween(Window.unboundedPreceding, -1))
        r = by.withColumn("below", F.coalesce(below, F.lit(0))).agg(
            F.sum(F.col("bad") * (F.col("below") + F.col("good") / 2)).alias("won"), F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
        out[n] = r.won / (r.bad * r.good) if r.bad and r.good else 0.5
    return out


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose score is under 0.5."""
    words, coefficients = fit(docs, labels)
    return sheltered(docs, lambda d: _with_score(d, words, coefficients).where("_nv_score < 0.5").drop("_nv_score"))


def _with_score(docs: DataFrame, words: dict, coefficients: tuple) -> DataFrame:
    inner = _score_pass(words, grammar(), coefficients)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        give_back()
        for batch in slices(batches):
            part = pa.RecordBatch.from_arrays([batch.column(names.index("text"))], ["text"])
            for scored in inner(iter([part])):
                yield pa.RecordBatch.from_arrays([*batch.columns, scored.column("score")], [*names, "_nv_score"])
        give_back()

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_nv_score", DoubleType())]))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
