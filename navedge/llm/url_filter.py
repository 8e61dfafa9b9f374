"""URL filter: rules first, then the ratio of two character language models.

Rules name a host and a path; a rule fits its host and all subdomains if the
url's path starts with the rule's path, and the longest rule wins. Urls that a
rule decides are the accepted and rejected examples of two variable-order
Markov models over characters. A gram is up to ``ORDER`` symbols; its
probability mixes its count with the probability of the gram without its first
symbol: p(c | s) = (n(sc) + MIX p(c | s')) / (n(s) + MIX), down to the uniform
one. At each place of a url the longest gram that was seen at all gives the
difference of the two log probabilities; their mean over the url's places is
compared with the threshold that parts the examples best. For the threshold,
the shapes fall into two halves by their hash, and each half is scored by the
model of the other one: an example's own counts never help it.

Everything is DataFrame functions. Rules read host and path; the models read
the whole url, query and fragment too. Urls are reduced to shapes (what follows
``://``, digits alike, 34 symbols), and counting and scoring work on distinct shapes.
The model has at most 34 + 34^2 + 34^3 + 34^4 = 1,376,924 grams, whatever the
number of urls: that bound is why it may be broadcast.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule; the method judges all of the latter's text, and null as
the empty shape; a null page_id stays null; repeated rows repeat; without examples of both verdicts
every url that no rule decides is allowed; equal mean and threshold allow;
equally good thresholds resolve to the smallest; extra columns are not read.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, staged

#: Host, path, verdict.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ORDER = 4
MIX = 2.0
SYMBOLS = 34
#: Width of a bin of mean differences when the threshold is chosen.
BIN = 0.01


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, whole (the url after ``://``, or all of it), host, path, rule, verdict of the rule (null if none fits)."""
    at = F.instr("url", "://")
    after = F.expr("substring(url, instr(url, '://') + 3)")
    rest = F.when(at > 0, after).otherwise("")
    whole = F.when(at > 0, after).otherwise(F.col("url"))
    host = F.translate(F.regexp_extract("rest", r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    split = pages.select("page_id", F.coalesce(whole, F.lit("")).alias("whole"), F.coalesce(rest, F.lit("")).alias("rest")).select(
        "page_id", "whole", host.alias("host"), F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"))
    longest_first = sorted(rules, key=lambda r: -len(r[0] + r[1]))

    def decide(value):
        return F.coalesce(*(F.when(((F.col("host") == h) | F.endswith("host", F.lit("." + h))) & F.startswith("path", F.lit(p)), value(h, p, v))
                            for h, p, v in longest_first), F.lit(None).cast("string"))

    return split.select("page_id", "whole", "host", "path", decide(lambda h, p, v: F.lit(h + p)).alias("rule"),
                        decide(lambda h, p, v: F.lit(v)).alias("by_rule"))


def shape(text):
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[0-9]", "0"), r"[^a-z0./_-]", "~")


def _grams(shapes: DataFrame, *keep: str) -> DataFrame:
    """Each place of a shape with the grams that end there, of 1 to ORDER symbols."""
    text = shapes.select(*keep, F.concat(F.lit("^"), "shape", F.lit("$")).alias("text"))
    places = text.select(*keep, "text", F.explode(F.sequence(F.lit(2), F.length("text"))).alias("place"))
    return places.select(*keep, "place", "text", F.explode(F.sequence(F.lit(1), F.least(F.lit(ORDER), "place"))).alias("size")).select(
        *keep, "place", "size", F.expr("substring(text, place - size + 1, size)").alias("gram"))


def model(shapes: DataFrame) -> DataFrame:
    """(gram, diff): log probability among accepted less that among rejected urls.

    ``shapes`` has shape, allow and block, the numbers of examples.
    """
    counts = staged(_grams(shapes.where("allow + block > 0"), "shape", "allow", "block").groupBy("gram", "size").agg(
        F.sum("allow").cast("double").alias("a"), F.sum("block").cast("double").alias("b")), "url-grams")
    contexts = counts.groupBy(F.expr("left(gram, size - 1)").alias("context"), F.col("size").alias("context_size")).agg(
        F.sum("a").alias("all_a"), F.sum("b").alias("all_b"))
    by_size, shorter = [], None
    for size in range(1, ORDER + 1):
        now = counts.where(F.col("size") == size).select("gram", "a", "b", F.expr("left(gram, size - 1)").alias("context"),
                                                         F.expr("substring(gram, 2)").alias("rest"))
        now = now.join(contexts.where(F.col("context_size") == size).drop("context_size"), "context")
        if shorter is None:
            now = now.withColumns({"rest_a": F.lit(1 / SYMBOLS), "rest_b": F.lit(1 / SYMBOLS)})
        else:
            now = now.join(shorter.select(F.col("gram").alias("rest"), F.col("p_a").alias("rest_a"), F.col("p_b").alias("rest_b")), "rest")
        shorter = staged(now.select("gram", *(((F.col(x) + MIX * F.col(f"rest_{x}")) / (F.col(f"all_{x}") + MIX)).alias(f"p_{x}") for x in "ab")),
                         "url-model")
        by_size.append(shorter)
    return reduce(DataFrame.unionByName, by_size).select("gram", F.log(F.col("p_a") / F.col("p_b")).alias("diff"))


def means(shapes: DataFrame, grams: DataFrame) -> DataFrame:
    """(shape, allow, block, mean) of distinct shapes; one shuffle, by shape."""
    keep = ("shape", "allow", "block")
    found = _grams(shapes.repartition("shape"), *keep).join(F.broadcast(grams), "gram", "left")
    by_place = found.groupBy(*keep, "place").agg(
        F.coalesce(F.max_by("diff", F.when(F.col("diff").isNotNull(), F.col("size"))), F.lit(0.0)).alias("diff"))
    # Rounded, as the order of a sum is not fixed.
    return by_place.groupBy(*keep).agg(F.round(F.sum("diff") / F.count(F.lit(1)), 9).alias("mean"))


def held_out_means(shapes: DataFrame) -> DataFrame:
    """``means`` of the examples' shapes, each under the model of the other half of the shapes: no example scores itself."""
    examples = shapes.where("allow + block > 0").withColumn("half", F.pmod(F.xxhash64("shape"), F.lit(2)))
    return reduce(DataFrame.unionByName, (means(examples.where(F.col("half") == half).drop("half"),
                                                model(examples.where(F.col("half") != half).drop("half"))) for half in (0, 1)))


def threshold(scored: DataFrame) -> float | None:
    """The mean at or above which urls are accepted: the best sum of both shares of examples on their side, midway
    between the bins of examples that it parts."""
    bins = scored.where("allow + block > 0").groupBy(F.floor(F.col("mean") / BIN).alias("bin")).agg(F.sum("allow").alias("a"), F.sum("block").alias("b"))
    in_order = Window.orderBy("bin")  # a row a bin; means span a few thousand bins
    below = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ranked = bins.select("bin", F.lag("bin").over(in_order).alias("before"),
                         F.sum("a").over(Window.partitionBy()).alias("all_a"), F.sum("b").over(Window.partitionBy()).alias("all_b"),
                         F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a_below"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b_below"))
    gain = F.round(F.col("b_below") / F.col("all_b") - F.col("a_below") / F.col("all_a"), 9)
    best = ranked.where("all_a > 0 AND all_b > 0").select("bin", "before", gain.alias("gain")).orderBy(F.desc("gain"), "bin").first()
    if best is None:
        return None
    return best.bin * BIN if best.before is None else (best.before + 1 + best.bin) / 2 * BIN


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mean (of the url's shape)."""
    ruled = with_rule(pages, rules).withColumn("shape", shape(F.col("whole")))
    shapes = staged(ruled.groupBy("shape").agg(F.count_if(F.col("by_rule") == "allow").alias("allow"),
                                               F.count_if(F.col("by_rule") == "block").alias("block")), "url-shapes")
    least = threshold(held_out_means(shapes))
    scored = staged(means(shapes, model(shapes)), "url-means")
    method = F.lit("allow") if least is None else F.when(F.col("mean") >= least, "allow").otherwise("block")
    return ruled.join(scored.select("shape", "mean"), "shape").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "mean")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages")).drop("mean")
