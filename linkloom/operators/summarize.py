"""What is told about pairs: paths, partners of each category, statistics, a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators.normalize import LEVELS, first_by_id


def attach_pretty_paths(pairs: DataFrame, cats: DataFrame) -> DataFrame:
    """left_path_pretty and right_path_pretty from the first row of each id."""
    named = first_by_id(cats.select(F.col("id").cast("string").alias("id"), "category_id", T.pretty_path(*LEVELS).alias("path_pretty")))
    pairs = pairs.drop("left_path_pretty", "right_path_pretty")
    for side in ("left", "right"):
        pairs = pairs.join(named.select(F.col("id").alias(f"{side}_id"), F.col("path_pretty").alias(f"{side}_path_pretty")), f"{side}_id", "left")
    return pairs


def summarize_per_category(pairs: DataFrame) -> DataFrame:
    """For each (id, source): numbers of different partners within and across sources."""
    roles = pairs.select(F.col("left_id").alias("id"), F.col("left_source").alias("source"), F.col("right_id").alias("partner"), "match_scope").unionByName(
        pairs.select(F.col("right_id").alias("id"), F.col("right_source").alias("source"), F.col("left_id").alias("partner"), "match_scope")
    )
    # distinct first, so that one shuffle serves both counts
    counts = roles.distinct().groupBy("id", "source").agg(*[F.count_if(F.col("match_scope") == s).alias(f"{s}_count") for s in ("intra", "cross")])
    return counts.withColumns({f"has_{s}": F.col(f"{s}_count") > 0 for s in ("intra", "cross")})


def attach_summary_flags(pairs: DataFrame, summary: DataFrame) -> DataFrame:
    """The counts and flags of both sides; 0 and false where there are none."""
    for side in ("left", "right"):
        s = summary.select(F.col("id").alias(f"{side}_id"), F.col("source").alias(f"{side}_source"), *[F.col(f"{k}_{x}").alias(f"{side}_{k}_{x}" if k == "has" else f"{side}_{k}_{x}") for k, x in (("intra", "count"), ("cross", "count"), ("has", "intra"), ("has", "cross"))])
        pairs = pairs.join(s, [f"{side}_id", f"{side}_source"], "left")
    flags = {f"{side}_has_{x}": False for side in ("left", "right") for x in ("intra", "cross")}
    counts = {f"{side}_{x}_count": 0 for side in ("left", "right") for x in ("intra", "cross")}
    return pairs.na.fill(flags).na.fill(counts)


def attach_source_raw(pairs: DataFrame, cats: DataFrame) -> DataFrame:
    """left_source_raw and right_source_raw by id."""
    if "source_raw" not in cats.columns:
        return pairs
    raw = first_by_id(cats.select(F.col("id").cast("string").alias("id"), "category_id", "source_raw"))
    for side in ("left", "right"):
        pairs = pairs.join(raw.select(F.col("id").alias(f"{side}_id"), F.col("source_raw").alias(f"{side}_source_raw")), f"{side}_id", "left")
    return pairs


def similarity_stats(pairs: DataFrame) -> DataFrame:
    """One row: count, min, max, mean and population standard deviation."""
    s = F.col("similarity")
    return pairs.agg(F.count(s).alias("n"), F.min(s).alias("min_similarity"), F.max(s).alias("max_similarity"), F.round(F.avg(s), 6).alias("mean_similarity"), F.round(F.stddev_pop(s), 6).alias("std_similarity"))


def counts_by_type(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("match_scope", "match_type").agg(F.count(F.lit(1)).alias("n"))


def paths_per_source(cats: DataFrame) -> DataFrame:
    return cats.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("path_norm").alias("n_paths"), F.count_distinct("id").alias("n_ids"))


def top_sample(pairs: DataFrame, n: int = 2000) -> DataFrame:
    """The first n pairs by scope, type and falling similarity."""
    return pairs.orderBy("match_scope", "match_type", F.desc("similarity"), "left_id", "right_id", "left_source", "right_source").limit(n)
