"""python -m linkloom: categories, resolve, products, extract."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from linkloom.operators import resolve
from linkloom.plans import categories, products
from linkloom.sources import readers, writers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linkloom")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("categories", help="match and resolve categories")
    c.add_argument("--kind", choices=["dated", "csv", "parquet", "query", "left_right"], default="csv")
    c.add_argument("--path", help="a file, or the root of dated folders")
    c.add_argument("--sql", help="for query")
    c.add_argument("--left-sql", help="for left_right")
    c.add_argument("--right-sql", action="append", default=[], help="for left_right; can be given several times")
    c.add_argument("--url", help="of a database, over JDBC; without it queries are on the session's tables")
    c.add_argument("--snapshot", help="where the rows are kept")
    c.add_argument("--use-snapshot", action="store_true", help="read the snapshot if it is there")
    c.add_argument("--sources", nargs="*", default=[])
    c.add_argument("--date", type=readers.date_prefix)
    c.add_argument("--as-of", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--threshold", type=float, default=0.8)
    c.add_argument("--block-by", choices=["none", "l1", "l1l2"], default="none")
    c.add_argument("--include-intra", action="store_true")
    c.add_argument("--intra-filter", choices=sorted(categories.INTRA_FILTERS), default="none")
    c.add_argument("--perm12", action="store_true", help="pairs with the first two levels swapped")
    c.add_argument("--synonyms", type=json.loads, default={}, help="of first levels, as a JSON object")
    c.add_argument("--name", help="of the run")
    c.add_argument("--mirror-to", help="a folder for copies under the run's name and under latest")
    c.add_argument("--no-resolve", action="store_true")
    c.add_argument("--stage", default="dev")
    c.add_argument("--upload-to")
    r = sub.add_parser("resolve", help="resolve pairs that were matched before")
    for x in ("pairs", "categories", "as-of", "out"):
        r.add_argument(f"--{x}", required=True)
    r.add_argument("--intra", action="store_true")
    d = sub.add_parser("products", help="match products")
    for x in ("feed", "listings", "out"):
        d.add_argument(f"--{x}", required=True)
    d.add_argument("--brands")
    d.add_argument("--threshold", type=float, default=0.75)
    d.add_argument("--block-threshold", type=float, default=0.35)
    d.add_argument("--block-threshold-secondary", type=float, default=0.6)
    d.add_argument("--max-per-left", type=int, default=300)
    d.add_argument("--scorer", choices=["fuzzy", "tfidf"], default="fuzzy")
    d.add_argument("--keep-columns", nargs="*", default=[], help="columns of the normalized products to write beside the matches")
    e = sub.add_parser("extract", help="write a query's rows as CSV to a dated folder")
    for x in ("sql", "root", "source", "date"):
        e.add_argument(f"--{x}", required=True)
    e.add_argument("--url")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("linkloom").getOrCreate()
    if a.command == "categories":
        options = {"dated": {"root": a.path, "sources": a.sources, "date": a.date}, "query": {"sql": a.sql, "url": a.url}, "left_right": {"left": a.left_sql, "rights": a.right_sql, "url": a.url}}.get(a.kind, {"path": a.path})
        missing = [k for k, v in options.items() if k not in ("url", "sources") and not v]
        if missing:
            parser().error(f"{a.kind} needs {', '.join(missing)}")
        raw = categories.ingest(spark, a.kind, snapshot=a.snapshot, use_snapshot=a.use_snapshot, **options)
        config = categories.CategoryConfig(as_of=a.as_of, threshold=a.threshold, block_by=a.block_by, include_intra=a.include_intra, intra_filter=a.intra_filter, enable_perm12=a.perm12, synonyms=a.synonyms)
        return categories.run(spark, raw, config, a.out, name=a.name, stage=a.stage, resolve_pairs=not a.no_resolve, upload_to=a.upload_to, mirror_to=a.mirror_to)
    if a.command == "resolve":
        pairs, cats = spark.read.parquet(a.pairs), readers.csv(spark, a.categories)
        cats = categories.normalize_categories(cats, as_of=a.as_of)
        found = {"resolution": resolve.cross_resolution(pairs, cats, as_of=a.as_of)}
        found["mapping"] = resolve.global_id_map(found["resolution"], cats, as_of=a.as_of)
        if a.intra:
            found["intra_resolution"], found["intra_pairwise"] = resolve.intra_resolution(pairs, cats, as_of=a.as_of)
        return {k: writers.write_parquet(v, f"{a.out}/{k}.parquet") for k, v in found.items()}
    if a.command == "products":
        config = products.ProductConfig(a.block_threshold, a.block_threshold_secondary, a.max_per_left, a.threshold, scorer=a.scorer, keep_columns=a.keep_columns)
        return products.run(spark, readers.csv_strings(spark, a.feed), readers.csv_strings(spark, a.listings), readers.csv_strings(spark, a.brands) if a.brands else None, config, a.out)
    return {"path": writers.write_csv(readers.query(spark, a.sql, url=a.url), readers.category_folder(a.root, a.source, a.date))}


def command() -> None:
    main()


if __name__ == "__main__":
    command()
