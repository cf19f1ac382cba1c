"""Cosine similarity of TF-IDF vectors as a join of n-grams.

A fit is a set of texts that share document frequencies, such as one pair of sources, or one
block of it. Weights are tf * (ln((1 + N) / (1 + df)) + 1), normalized to length 1.

Pairs below a threshold are never formed: grams are ordered rare first, and a text joins only
by its prefix, after which the rest of its vector is shorter than the threshold. Two texts
without a gram in both prefixes can't reach the threshold, since what they share lies in the rest
of one of them. Cosines of the candidates are exact.

Texts are numbered, grams are 64-bit hashes and a text's vector is one row with arrays, so what
is shuffled for a gram is three numbers, and a candidate pair is two.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linkloom.operators.lineage import cut


def char_grams(c: str | Column, low: int = 3, high: int = 5) -> Column:
    """N-grams of each word with a space on both sides, with repetitions."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")

    def of_word(w: Column) -> Column:
        padded, size = F.concat(F.lit(" "), w, F.lit(" ")), F.length(w) + 2
        return F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), size)), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(padded, i, n))))

    return F.flatten(F.transform(found, of_word))


def word_grams(c: str | Column, high: int = 2) -> Column:
    """Runs of 1 to ``high`` words of two characters or more."""
    c = F.col(c) if isinstance(c, str) else c
    found = F.filter(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\b\w\w+\b)"), F.lit(1)), lambda w: w != "")

    def runs(n: int) -> Column:
        # a lambda for transform has one parameter, as a second one would get the element's place
        return F.when(F.size(found) >= n, F.transform(F.sequence(F.lit(1), F.size(found) - n + 1), lambda i: F.array_join(F.slice(found, i, n), " "))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.array(*[runs(n) for n in range(1, high + 1)]))


def vectors(texts: DataFrame, grams: Column, threshold: float = 0.0) -> DataFrame:
    """(text, of, fit, side, key, g, w, prefix) from one row for each (fit, side, key), cut to the checkpoint folder.

    ``text`` is a number for each row and ``of`` a hash of its fit; ``g`` and ``w`` have the
    text's grams, rare first, and their weights; the first ``prefix`` of them are to be joined
    for ``threshold``. Texts without a gram have no vector. A text counts as often as its
    ``copies`` say, if there are any.
    """
    texts = texts if "copies" in texts.columns else texts.withColumn("copies", F.lit(1))
    sizes = texts.groupBy("fit").agg(F.sum("copies").alias("n"))
    t = cut(texts.withColumn("grams", F.transform(grams, lambda x: F.xxhash64(x))).join(sizes, "fit").withColumns({"text": F.monotonically_increasing_id(), "of": F.xxhash64("fit")}))
    tf = t.select("text", "of", "copies", F.explode("grams").alias("g")).groupBy("text", "of", "copies", "g").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("of", "g").agg(F.sum("copies").alias("df"))
    found = tf.join(df, ["of", "g"]).groupBy("text").agg(F.array_sort(F.collect_list(F.struct("df", "g", "tf"))).alias("x")).join(t.drop("grams"), "text")
    raw = F.transform("x", lambda e: e["tf"] * (F.log((1 + F.col("n")) / (1 + e["df"])) + 1))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, e: a + e * e))
    v = found.withColumn("raw", raw).withColumn("norm", norm).withColumn("w", F.transform("raw", lambda e: e / F.col("norm")))
    rest = F.lit(threshold * threshold - 1e-9)
    if threshold > 0:
        start = F.struct(F.lit(1.0).alias("rest"), F.lit(0).alias("n"))
        prefix = F.aggregate("w", start, lambda a, e: F.struct((a["rest"] - e * e).alias("rest"), (a["n"] + F.when(a["rest"] >= rest, 1).otherwise(0)).alias("n")), lambda a: a["n"])
    else:
        prefix = F.size("w")
    return cut(v.select("text", "of", "fit", "side", "key", F.transform("x", lambda e: e["g"]).alias("g"), "w", prefix.alias("prefix")))


@F.arrow_udf(DoubleType())
def _dot(gl: pa.Array, wl: pa.Array, gr: pa.Array, wr: pa.Array) -> pa.Array:
    """Dot products of sparse vectors, a row each."""
    n = len(gl)
    row = np.concatenate([np.repeat(np.arange(n), np.diff(g.offsets.to_numpy())) for g in (gl, gr)])
    g = np.concatenate([np.asarray(x.flatten()) for x in (gl, gr)])
    w = np.concatenate([np.asarray(x.flatten()) for x in (wl, wr)])
    key = (g.view(np.uint64) ^ (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD1342543DE82EF95)
    order = np.argsort(key)
    at = np.flatnonzero(key[order[1:]] == key[order[:-1]]) if len(order) else order
    a, b = order[at], order[at + 1]
    same = (row[a] == row[b]) & (g[a] == g[b])
    return pa.array(np.bincount(row[a[same]], w[a[same]] * w[b[same]], n))


def _met(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(fit, left_key, right_key, similarity) of pairs (l, r) of texts with a common gram."""
    l = left.select(F.col("text").alias("l"), "fit", F.col("key").alias("left_key"), F.col("g").alias("gl"), F.col("w").alias("wl"))
    r = right.select(F.col("text").alias("r"), F.col("key").alias("right_key"), F.col("g").alias("gr"), F.col("w").alias("wr"))
    return candidates.join(l, "l").join(r, "r").select("fit", "left_key", "right_key", _dot("gl", "wl", "gr", "wr").alias("similarity")).where("similarity > 0")


def cosines(texts: DataFrame, grams: Column, asked: DataFrame) -> DataFrame:
    """(left_key, right_key, similarity) of the pairs asked for, (left_key, right_key), of one fit of ``texts``, whose keys differ; those without a common gram are left out."""
    v = vectors(texts.withColumns({"fit": F.lit(0), "side": F.lit("l")}), grams)
    number = v.select("text", "key")
    pairs = asked.join(number.select(F.col("text").alias("l"), F.col("key").alias("left_key")), "left_key").join(number.select(F.col("text").alias("r"), F.col("key").alias("right_key")), "right_key").select("l", "r")
    return _met(pairs, v, v).drop("fit")


def similar_pairs(texts: DataFrame, grams: Column, threshold: float, *, within: bool = False) -> DataFrame:
    """All pairs of a fit with cosine of at least ``threshold``, rounded to 9 digits: left against right side, or, ``within`` one side, each pair once."""
    if within:
        texts = texts.withColumn("side", F.lit("l"))
    v = vectors(texts, grams, threshold)
    left = v.where("side = 'l'")
    right = left if within else v.where("side = 'r'")
    l, r = (x.select("of", F.col("text").alias(side), *([F.col("key").alias(f"key_{side}")] if within else []), F.explode(F.slice("g", F.lit(1), F.col("prefix"))).alias("g")) for x, side in ((left, "l"), (right, "r")))
    candidates = l.join(r, ["of", "g"])
    if within:
        candidates = candidates.where("key_l < key_r")
    found = _met(candidates.select("l", "r").distinct(), left, right)
    return found.withColumn("similarity", F.round("similarity", 9)).where(F.col("similarity") >= F.lit(threshold))


def best_left(found: DataFrame) -> DataFrame:
    """For each left text the most similar right one; of ties, the smallest."""
    w = Window.partitionBy("fit", "left_key").orderBy(F.desc("similarity"), "right_key")
    return found.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def mutual_best(found: DataFrame) -> DataFrame:
    """Pairs that are each other's best."""
    l = Window.partitionBy("fit", "left_key").orderBy(F.desc("similarity"), "right_key")
    r = Window.partitionBy("fit", "right_key").orderBy(F.desc("similarity"), "left_key")
    return found.withColumns({"__l": F.row_number().over(l), "__r": F.row_number().over(r)}).where("__l = 1 and __r = 1").drop("__l", "__r")
