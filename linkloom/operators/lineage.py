"""Cutting lineage in the shared checkpoint folder, for iterative operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint. The folder is the cluster's spark.checkpoint.dir; a local one is made only in local mode where that is unset."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            import tempfile

            named = tempfile.mkdtemp(prefix="linkloom-lineage-")
        sc.setCheckpointDir(named)
    return df.checkpoint(eager=True)
