"""Writing: run folders, tables as Parquet and CSV, metrics as JSON, mirrors."""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_id(date: str | None = None, tag: str | None = None) -> str:
    """Date and a random part; or, without a date, the time."""
    stamp = f"{date}_{uuid.uuid4().hex[:8]}" if date else datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    return f"{stamp}_{tag}" if tag else stamp


def run_folder(spark: SparkSession, root: str, name: str) -> str:
    """A folder for a run, on any file system."""
    path = f"{root.rstrip('/')}/{name}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def point_latest(spark: SparkSession, root: str, name: str) -> str:
    """Lets "latest" in the root lead to a run: a link on a local file system, elsewhere a file that holds the run's name."""
    link = f"{root.rstrip('/')}/latest"
    if "://" in root:
        return write_text(spark, link, name)
    if os.path.islink(link):
        os.unlink(link)
    if not os.path.exists(link):
        os.symlink(name, link)
    return link


def write_text(spark: SparkSession, path: str, text: str) -> str:
    """A small file through Hadoop's file systems, so any URI will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def write_json(spark: SparkSession, path: str, value: dict) -> str:
    return write_text(spark, path, json.dumps(value, indent=2, sort_keys=True, default=str))


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, one_file: bool = False) -> str:
    flat = df.select(*[F.col(c).cast("string").alias(c) if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes])
    (flat.coalesce(1) if one_file else flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def without_load_time(df: DataFrame) -> DataFrame:
    return df.drop("load_timestamp")


def mirror(spark: SparkSession, folder: str, *targets: str) -> list[str]:
    """Copies a folder to each target URI."""
    conf = spark._jsc.hadoopConfiguration()
    jvm = spark._jvm
    source = jvm.org.apache.hadoop.fs.Path(folder)
    for t in targets:
        to = jvm.org.apache.hadoop.fs.Path(t)
        fs = to.getFileSystem(conf)
        if fs.exists(to):
            fs.delete(to, True)
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, fs, to, False, conf)
    return list(targets)


def mapping_name(stage: str) -> str:
    return f"{stage}_categories_id_mapping"


def publish_categories(spark: SparkSession, folder: str, results: dict, *, stage: str = "dev", upload_to: str | None = None) -> dict[str, str]:
    """Writes what a run made (pairs, summary, sample, resolution, mapping, metrics); gives the paths. ``upload_to``: a folder URI for another copy of the mapping."""
    out: dict[str, str] = {}
    for name in ("raw", "normalized", "pairs", "summary", "resolution"):
        if results.get(name) is not None:
            out[name] = write_parquet(without_load_time(results[name]), f"{folder}/{name}.parquet")
    for name in ("sample", "resolution"):
        if results.get(name) is not None:
            out[f"{name}_csv"] = write_csv(results[name], f"{folder}/{name}.csv", one_file=name == "sample")
    if results.get("mapping") is not None:
        name = mapping_name(stage)
        out["mapping"] = write_parquet(without_load_time(results["mapping"]), f"{folder}/{name}.parquet")
        out["mapping_csv"] = write_csv(spark.read.parquet(out["mapping"]), f"{folder}/{name}.csv")
        if upload_to:
            out["mapping_upload"] = write_parquet(spark.read.parquet(out["mapping"]), f"{upload_to.rstrip('/')}/{name}.parquet")
    out["metrics"] = write_json(spark, f"{folder}/metrics.json", {**results.get("metrics", {}), "outputs": dict(out)})
    return out
