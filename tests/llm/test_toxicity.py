import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from navedge.llm import toxicity as X

from .data import SF, docs


def weight(text, learned=None):
    words = X.lexicon(learned or {})
    hits = frozenset(w for w, (kind, _) in words.items() if kind in ("insult", "threat"))
    return X.clause_weights(text, words, hits, X.grammar())


def test_composition_is_one_table_that_reads_classes():
    arcs = X.grammar()
    states = {s for s, _ in arcs}
    assert all(t in states for t, _, _ in arcs.values())
    assert {c for _, c in arcs} == {"other", "target", "report", "neg", "insult", "threat"}
    assert {out for _, out, _ in arcs.values()} == {"other", *X.KINDS}


def in_sequence(text, words):
    """Clause weights by the five transducers one after another, each over the whole output of the one before."""
    out = []
    for clause in re.split(r"[.!?;\n]+", text.lower()):
        tape = [(*words.get(w, ("other", 0.0)), 1.0) for w in re.findall(r"[\w']+", clause)]
        for part in X.parts():
            state, made = 0, []
            for symbol, weight, factor in tape:
                state, symbol, f = part[state, symbol]
                made.append((symbol, weight, factor * f))
            tape = made
        total = tuple(sum(w * f for s, w, f in tape if s == k) for k in X.KINDS)
        if any(total):
            out.append(total)
    return out


def test_composition_equals_the_transducers_in_sequence():
    rng = random.Random(3)
    classes = [X.INSULTS[:4], X.THREATS[:3], X.TARGETS[:3], X.NEGATORS[:3], X.REPORTS[:3], ["tree", "café", "runs"], [".", ";", "\n", "!?"]]
    for _ in range(400):
        text = " ".join(rng.choice(rng.choice(classes)) for _ in range(rng.randint(0, 40)))
        assert [tuple(round(x, 9) for x in w) for w in weight(text)] == [tuple(round(x, 9) for x in w) for w in in_sequence(text, X.lexicon({}))]


def test_clauses_not_words():
    insult, prior = "idiot", X.PRIOR_WEIGHT
    assert weight(f"an {insult} sat there") == [(0, prior, 0)]
    assert weight(f"you are an {insult}") == [(prior * 1.5, 0, 0)]
    assert weight(f"he is not an {insult}") == [(0, 0, prior * 1.5 * 0.25)] and weight(f"he said she was an {insult}") == [(0, 0, prior * 0.5 * 1.5)]
    assert weight(f"not here at all and then an {insult}") == [(0, prior, 0)]  # the negator is too far away
    assert weight("I will kill you") == [(prior * 1.25, 0, 0)]
    assert len(weight("idiot! moron; scum")) == 3
    assert weight("") == weight("a fine day") == weight("idiotic") == []
    # what nobody is the target of weighs as the labels say, apart from whole patterns
    z = lambda text: X.DEFAULT_FIT[0] + sum(a * b for a, b in zip(X.DEFAULT_FIT[1:], X.features(weight(text))))
    assert z("you idiot") > z("an idiot") > z("you are not an idiot") == X.DEFAULT_FIT[0]


def test_clause_weight_is_fitted_apart_from_lone_words(spark):
    """Lone words stand in texts of both kinds, whole patterns in toxic ones only: the grammar tells them apart."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        fill = [" ".join(rng.choice("abcdefgh") * rng.randint(2, 5) for _ in range(8)) for _ in range(4)]
        bad = i % 3 == 0
        fill[rng.randrange(4)] += rng.choice([" you are a moron", " you utter moron", " you total moron", " they are one moron"]) if bad else " the moron sat there"
        rows.append((i, ". ".join(fill) + "."))
        labels.append((i, 1, int(bad)))
    d, marked = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(d, marked)
    fit = dict(zip(X.FEATURES, model[1][1:]))
    assert fit["clause", "total"] + fit["clause", "greatest"] > 1 and fit["lone", "total"] + fit["lone", "greatest"] < 0.5
    auc = X.held_out_auc(d, marked, model)
    assert auc["score"] == 1.0 and auc["greatest_word"] < 0.6


def refit(rows, labels):
    """The whole fit in plain Python: contexts, words, weights, features, Newton's steps."""
    known = {i: t for i, _, t in labels if zlib.crc32(str(i).encode()) % 5}
    sample = [(t, known[i]) for i, t in rows if i in known and t is not None]
    seen = defaultdict(set)
    for text, toxic in sample:
        w = [x for x in re.split(r"[^\w']+", text.lower()) if x]
        for a, b in zip([None, *w], w):
            seen[b, a].add(toxic)
    count = defaultdict(lambda: [0, 0])
    for (word, _), kinds in seen.items():
        for k in kinds:
            count[word][k] += 1
    often = {w: c for w, c in count.items() if sum(c) >= X.MIN_CONTEXTS}
    good, bad = (sum(c[k] for c in often.values()) for k in (0, 1))
    base, learned = bad / (bad + good), {}
    for w, (g, b) in count.items():
        share = b / (b + g)
        if b >= X.MIN_CONTEXTS and share >= (1 + base) / 2:
            left = (1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0
            if math.exp(-(b + g) * (share * math.log(share / base) + left)) * len(often) < X.CHANCE:
                learned[w] = min(max(math.log((b + 0.5) / (g + 0.5)) - math.log(bad / good), X.WEIGHT_RANGE[0]), X.WEIGHT_RANGE[1])
    against = {w for w in (*X.INSULTS, *X.THREATS) if w in often and often[w][1] / sum(often[w]) <= base} - learned.keys()
    words = X.lexicon(learned, against)
    f = np.array([X.features(in_sequence(t, words)) for t, _ in sample])
    return words, X._logistic(f, np.array([y for _, y in sample], float))


def test_fit_and_scores_equal_the_plain_form(spark):
    d, labels = data(spark)
    rows, marked = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()], [tuple(r) for r in labels.collect()]
    words, coefficients = refit(rows, marked)
    model = X.fit(d, labels)
    assert model[0].keys() == words.keys() and all(model[0][w][0] == words[w][0] and abs(model[0][w][1] - words[w][1]) < 1e-9 for w in words)
    assert np.allclose(model[1], coefficients, atol=1e-6)
    z = {i: coefficients[0] + np.dot(coefficients[1:], X.features(in_sequence(t, words))) for i, t in rows}
    assert all(abs(r.score - 1 / (1 + math.exp(-z[r.doc_id]))) < 1e-6 for r in X.score(d, model).collect())


def data(spark, n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("abcdefgh") * rng.randint(1, 5) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbo", "Snark", "flib"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(bad)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_words_from_training_rows_only(spark):
    d, labels = data(spark)
    model = X.fit(d, labels)
    assert {"grumbo", "snark", "flib"} <= model[0].keys()
    scored = X.score(d, model).join(labels, "doc_id").where(X.held_out(F.col("doc_id"))).collect()
    assert scored and all((r.score >= 0.5) == bool(r.toxic) for r in scored)
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert X.fit(d, flipped) == model


def test_awkward_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (3, "you idiot"), (3, "you idiot"), (None, "you idiot"), (4, "word " * 300000 + "you moron")]
    model = X.fit(docs(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert model[1] == X.DEFAULT_FIT
    got = X.score(docs(spark, rows), model).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert {r.score >= 0.5 for r in got if r.text and "you" in r.text} == {True}
    assert X.keep_clean(docs(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 2
    assert X.score(docs(spark, []), model).count() == 0


def test_clashing_names_stay(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    d = docs(spark, [(1, "you idiot"), (2, "a tree")]).selectExpr("*", "doc_id AS _nv_score", "'f' AS _nv_file", "text AS _nv_row")
    kept = X.keep_clean(d, none)
    assert kept.columns == d.columns and [(r._nv_score, r._nv_row) for r in kept.collect()] == [(2, "a tree")]


def test_query(spark):
    got = X.op1_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == 200
