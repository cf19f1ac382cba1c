"""Matching and resolving categories, from raw table to global identifiers."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators import pairs as G
from linkloom.operators import resolve, summarize
from linkloom.operators.lineage import cut
from linkloom.operators.normalize import normalize_categories
from linkloom.sources import readers, writers


INTRA_FILTERS = {"none": lambda pairs, norm: pairs, "parent_child": G.drop_intra_parent_child, "last_child": G.drop_different_last_child}


@dataclass
class CategoryConfig:
    """``block_by``: none, l1 or l1l2. ``enable_perm12`` adds swapped levels to TF-IDF pairs; ``include_intra`` adds pairs within sources, of which ``intra_filter`` (none, parent_child or last_child) drops some."""

    as_of: str
    threshold: float = 0.78
    block_by: str = "none"
    include_intra: bool = False
    intra_filter: str = "none"
    include_unordered_exact: bool = True
    enable_perm12: bool = False
    synonyms: dict[str, str] = field(default_factory=dict)
    sample_limit: int = 2000
    source_order: list[str] | None = None
    unicode: bool = True

    def __post_init__(self) -> None:
        if self.block_by not in ("none", "l1", "l1l2"):
            raise ValueError("block_by is none, l1 or l1l2")
        if self.intra_filter not in INTRA_FILTERS:
            raise ValueError(f"intra_filter is one of {', '.join(INTRA_FILTERS)}")


def generate_pairs(norm: DataFrame, config: CategoryConfig) -> DataFrame:
    """All generators of the flow across sources, each pair of one type once."""
    if config.block_by != "none":
        similar = G.tfidf_cross_blocked(norm, config.threshold, config.block_by)
    elif config.enable_perm12:
        similar = G.tfidf_cross_with_perm12(norm, config.threshold)
    else:
        similar = G.tfidf_cross_mutual(norm, config.threshold)
    similar = cut(similar)  # two consumers, and by far the most work
    found = [G.exact_cross(norm, source_order=config.source_order), similar]
    if config.include_unordered_exact:
        found.append(G.unordered_exact_fallback(norm, similar))
    found += [G.l3_l3_cross(norm), G.l2_l3_cross(norm)]
    if config.include_intra:
        found.append(INTRA_FILTERS[config.intra_filter](generate_intra_pairs(norm, config), norm))
    return G.combined(*found)


def generate_intra_pairs(norm: DataFrame, config: CategoryConfig) -> DataFrame:
    """Pairs within sources: equal paths, the same levels in any order, and TF-IDF."""
    similar = G.tfidf_intra(norm, config.threshold) if config.block_by == "none" else G.tfidf_intra_blocked(norm, config.threshold, config.block_by)
    found = [G.exact_intra(norm), similar]
    if config.include_unordered_exact:
        found.append(G.unordered_exact_intra(norm))
    return G.combined(*found)


def match(raw: DataFrame, config: CategoryConfig) -> dict[str, DataFrame]:
    """raw, normalized, pairs (with paths, flags and raw sources), summary and sample."""
    norm = cut(normalize_categories(raw, as_of=config.as_of, synonyms=config.synonyms, unicode=config.unicode))
    found = cut(generate_pairs(norm, config))
    summary = summarize.summarize_per_category(found)
    told = summarize.attach_source_raw(summarize.attach_summary_flags(summarize.attach_pretty_paths(found, norm), summary), norm)
    told = cut(told)
    return {"raw": raw, "normalized": norm, "pairs": told, "summary": summary, "sample": summarize.top_sample(told, config.sample_limit)}


def resolve_matches(results: dict[str, DataFrame], config: CategoryConfig, *, policy: str = "left") -> dict[str, DataFrame]:
    """Adds resolution, mapping and, if there are pairs within sources, intra_resolution and intra_pairwise. Ids are those of the normalized table."""
    cats = results["normalized"]
    resolution = cut(resolve.cross_resolution(results["pairs"], cats, as_of=config.as_of, policy=policy))
    out = results | {"resolution": resolution, "mapping": resolve.global_id_map(resolution, cats, as_of=config.as_of)}
    if config.include_intra:
        out["intra_resolution"], out["intra_pairwise"] = resolve.intra_resolution(results["pairs"], cats, as_of=config.as_of)
    return out


def metrics(results: dict[str, DataFrame], config: CategoryConfig) -> dict:
    """Totals, statistics of similarity, and counts by type and source."""
    stats = summarize.similarity_stats(results["pairs"]).first().asDict()
    return {
        "threshold": config.threshold,
        "block_by": config.block_by,
        "records_total": results["normalized"].count(),
        "matches_total": stats["n"],
        "similarity_stats": stats if stats["n"] else {},
        "by_type": {f"{r['match_scope']}/{r['match_type']}": r["n"] for r in summarize.counts_by_type(results["pairs"]).collect()},
        "sources": [r.asDict() for r in summarize.paths_per_source(results["normalized"]).orderBy("source").collect()],
    }


def run(spark: SparkSession, raw: DataFrame, config: CategoryConfig, out: str, *, name: str | None = None, stage: str = "dev", resolve_pairs: bool = True, upload_to: str | None = None, mirror_to: str | None = None) -> dict[str, str]:
    """The whole run, with its results written to a folder of its own under ``out``, which "latest" then points to. ``mirror_to``: a folder that gets a copy under the run's name and one under "latest"."""
    began = time.time()
    results = match(raw, config)
    if resolve_pairs:
        results = resolve_matches(results, config)
    told = metrics(results, config) | {"timing_seconds_total": round(time.time() - began, 3)}
    name = name or writers.run_id()
    folder = writers.run_folder(spark, out, name)
    paths = writers.publish_categories(spark, folder, results | {"metrics": told}, stage=stage, upload_to=upload_to)
    writers.point_latest(spark, out, name)
    if mirror_to:
        paths["mirror"], paths["mirror_latest"] = writers.mirror(spark, folder, *(f"{mirror_to.rstrip('/')}/{x}" for x in (name, "latest")))
    return paths


def ingest(spark: SparkSession, kind: str, *, snapshot: str | None = None, use_snapshot: bool = True, save_snapshot: bool = True, **options) -> DataFrame:
    """``kind``: dated (folders), csv, query, left_right (queries) or parquet. ``snapshot``: where the rows are kept after the first time, and read from later."""

    def make() -> DataFrame:
        if kind == "dated":
            return readers.dated_categories(spark, **options)
        if kind == "csv":
            return readers.csv(spark, **options)
        if kind == "query":
            return readers.query(spark, **options)
        if kind == "left_right":
            shared = {k: v for k, v in options.items() if k not in ("left", "rights")}
            return readers.left_right(readers.query(spark, options["left"], **shared), [readers.query(spark, r, **shared) for r in options["rights"]])
        if kind == "parquet":
            return readers.parquet(spark, **options)
        raise ValueError(f"no such source: {kind}")

    return readers.snapshot(spark, snapshot, make, use=use_snapshot, save=save_snapshot)
