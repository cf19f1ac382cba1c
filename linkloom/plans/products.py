"""Matching products, from two raw tables to scored pairs."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.operators import products as P
from linkloom.operators.lineage import cut
from linkloom.sources import writers


@dataclass
class ProductConfig:
    block_threshold: float = 0.6
    second_block_threshold: float = 0.5
    max_per_left: int = 60
    threshold: float = 0.75
    measure_tolerance: float = 0.15
    parse_units: bool = False
    include_description: bool = False
    scorer: str = "fuzzy"
    keep_columns: list[str] = field(default_factory=list)


def match(feed: DataFrame, listings: DataFrame, brands: DataFrame | None, config: ProductConfig, **normalizing) -> dict[str, DataFrame]:
    """normalized, candidates and matches."""
    norm = cut(P.normalize_products(feed, listings, brands, **normalizing))
    kinds, members = P.kinds(norm, include_description=config.include_description)
    pairs = cut(P.blocking_kinds_multipass(kinds, members, config.block_threshold, config.second_block_threshold, config.max_per_left, measure_tolerance=config.measure_tolerance, parse_units=config.parse_units))
    candidates = P.of_products(pairs, members).select("left_key", "right_key", "brand_name_norm", "name_jaccard")
    score = {"fuzzy": P.fuzzy_matches, "tfidf": P.tfidf_matches}[config.scorer]
    return {"normalized": norm, "candidates": candidates, "matches": P.matches_of_kinds(score, kinds, members, pairs, config.threshold, include_description=config.include_description)}


def run(spark: SparkSession, feed: DataFrame, listings: DataFrame, brands: DataFrame | None, config: ProductConfig, out: str, **normalizing) -> dict:
    """Writes the matches and metrics.json to ``out``; returns the metrics."""
    began = time.time()
    found = match(feed, listings, brands, config, **normalizing)
    matches = spark.read.parquet(writers.write_parquet(found["matches"], f"{out}/matches.parquet"))
    counts = {r["source"]: r["count"] for r in found["normalized"].groupBy("source").count().collect()}
    kinds = {r["match_type"]: r["count"] for r in matches.groupBy("match_type").count().collect()}
    told = {"inputs": counts, "candidates": found["candidates"].count(), "exact": kinds.get("exact", 0), "fuzzy": kinds.get("fuzzy", 0), "matches_total": matches.agg(F.count(F.lit(1))).first()[0], "threshold": config.threshold, "max_per_left": config.max_per_left, "timing_seconds_total": round(time.time() - began, 3)}
    if config.keep_columns:
        writers.write_parquet(P.kept(found["normalized"], config.keep_columns), f"{out}/normalized.parquet")
    writers.write_json(spark, f"{out}/metrics.json", told)
    return told
