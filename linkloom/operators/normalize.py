"""Categories in the form that matching works on, and the contracts of raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text as T

LEVELS = ["level_one", "level_two", "level_three"]
RAW = ["category_id", *LEVELS, "source", "updated_at"]


def with_missing(df: DataFrame, columns: list[str], value: str | None = "") -> DataFrame:
    """Adds the columns that aren't there, as strings."""
    return df.withColumns({c: F.lit(value).cast("string") for c in columns if c not in df.columns})


def raw_contract(df: DataFrame, *, external: str = "external_id") -> DataFrame:
    """The six raw columns. ``external_id`` stands in for a missing category_id; without either, rows are numbered by their content."""
    if "category_id" not in df.columns and external in df.columns:
        df = df.withColumnRenamed(external, "category_id")
    absent = [c for c in (*LEVELS, "source", "updated_at") if c not in df.columns]
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    if "category_id" not in df.columns:
        df = df.withColumn("category_id", F.substring(T.row_id("source", *LEVELS), 1, 16))
    return df.select(*RAW)


def with_match_side(df: DataFrame) -> DataFrame:
    """A match_side, where there is one, replaces the source, which is kept as source_raw."""
    if "match_side" not in df.columns:
        return df
    return df.withColumn("source_raw", F.col("source")).withColumn("source", F.coalesce("match_side", "source"))


def normalize_categories(df: DataFrame, *, as_of: str, synonyms: dict[str, str] | None = None, strip_unspecified: bool = False, unicode: bool = True) -> DataFrame:
    """Adds l1_norm, l2_norm, l3_norm, is_infused, path_norm and, where it is blank, id.

    Null levels read "uncategorized", blank ones are left out of the path. Timestamps that can't
    be read become ``as_of``. ``strip_unspecified`` removes "(unspecified)" from the second level
    before punctuation goes.
    """
    df = with_match_side(with_missing(df, ["id", "updated_at"], None))
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("uncategorized")) for c in LEVELS})
    second = T.without_unspecified(F.lower("level_two")) if strip_unspecified else F.col("level_two")
    norm = lambda c: T.normalize_text(c, unicode=unicode)
    # one projection for each step that uses its input twice, or expressions would double with every step
    df = df.withColumn("__plain", norm("level_one"))
    df = df.withColumns({"__one": T.singular(T.synonym("__plain", synonyms)), "l2_norm": T.singular(norm(second)), "l3_norm": T.singular(norm("level_three"))})
    df = df.withColumns({"is_infused": T.is_infused("__one"), "l1_norm": T.without_infused("__one")}).drop("__one", "__plain")
    df = df.withColumn("path_norm", T.join_path("l1_norm", "l2_norm", "l3_norm", normalized=True))
    origin = "source_raw" if "source_raw" in df.columns else "source"
    return df.withColumns({"id": F.coalesce(T.blank_to_null("id"), T.row_id(origin, *LEVELS)), "updated_at": T.to_timestamp_or("updated_at", as_of)})


def category_contract(df: DataFrame, *, as_of: str) -> DataFrame:
    """What resolution needs: all its columns, no null timestamp, an id in every row."""
    df = with_missing(df, ["id", "category_id", "global_id", *LEVELS, "source", "updated_at"])
    origin = "source_raw" if "source_raw" in df.columns else "source"
    return df.withColumns(
        {
            "category_id": F.coalesce(T.blank_to_null("category_id", "nan"), F.lit("")),
            "global_id": F.coalesce(T.blank_to_null("global_id", "nan", "none"), F.lit("")),
            "updated_at": T.to_timestamp_or("updated_at", as_of),
            "id": F.coalesce(T.blank_to_null("id"), T.row_id(origin, *LEVELS)),
        }
    )


def first_by_id(df: DataFrame, *order: str) -> DataFrame:
    """One row for each id, the first by ``order`` (category_id unless given)."""
    keys = order or tuple(c for c in ("category_id", "source", "path_pretty") if c in df.columns)
    w = Window.partitionBy("id").orderBy(*[F.col(c).asc_nulls_last() for c in keys] or [F.lit(1)])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
