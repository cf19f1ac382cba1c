"""Generators of candidate pairs of categories.

All work on normalized categories (id, source, l1_norm, l2_norm, l3_norm, path_norm) and return
left_source, right_source, left_id, right_id, similarity, match_scope and match_type. Pairs of
sources are one self-join with the left source before the right one, not a job for each pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators import tfidf
from linkloom.operators.lineage import cut

PAIR = ["left_source", "right_source", "left_id", "right_id", "similarity", "match_scope", "match_type"]
PAIR_SQL = "left_source string, right_source string, left_id string, right_id string, similarity double, match_scope string, match_type string"
RANK = {"exact": 0, "tfidf": 1, "perm12_exact": 2, "unordered_exact": 3, "l3_exact": 4, "l2_l3_exact": 5}


def rank_of(match_type: str | Column = "match_type") -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in RANK.items() for x in kv])
    return F.coalesce(F.try_element_at(ranks, F.col(match_type) if isinstance(match_type, str) else match_type), F.lit(len(RANK)))


def before(left: Column, right: Column, order: list[str] | None) -> Column:
    """Whether a source is on the left of another: by the order given, else by name."""
    if not order:
        return left < right
    at = F.array(*[F.lit(x) for x in order])
    return F.array_position(at, left) < F.array_position(at, right)


def keyed(df: DataFrame, key: Column, *more: str) -> DataFrame:
    """Distinct (source, id, key) without nulls."""
    return df.select("source", F.col("id").cast("string").alias("id"), key.alias("key"), *more).where("source is not null and id is not null and key is not null").distinct()


def sides(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select("key", *[F.col(c).alias(f"{s}_{c}") for c in columns]) for s in ("left", "right"))


def as_pairs(df: DataFrame, scope: str, kind: str, similarity: Column | None = None) -> DataFrame:
    return df.withColumns({"similarity": F.lit(1.0) if similarity is None else similarity, "match_scope": F.lit(scope), "match_type": F.lit(kind)}).select(*PAIR)


def equal_cross(df: DataFrame, key: Column, kind: str, order: list[str] | None = None, right_key: Column | None = None) -> DataFrame:
    """All pairs across sources whose keys are equal."""
    left = sides(keyed(df, key), "source", "id")[0]
    right = sides(keyed(df, key if right_key is None else right_key), "source", "id")[1]
    return as_pairs(left.join(right, "key").where(before(F.col("left_source"), F.col("right_source"), order)), "cross", kind)


def exact_cross(df: DataFrame, *, source_order: list[str] | None = None) -> DataFrame:
    """Equal paths across sources; the empty path counts too."""
    return equal_cross(df, F.col("path_norm"), "exact", source_order)


def exact_intra(df: DataFrame) -> DataFrame:
    """Equal paths within a source, each pair of ids once."""
    return equal_intra(df, F.col("path_norm"), "exact")


def equal_intra(df: DataFrame, key: Column, kind: str) -> DataFrame:
    left, right = sides(keyed(df, key), "source", "id")
    met = left.join(right.withColumnRenamed("right_source", "__s"), "key").where("left_source = __s and left_id < right_id")
    return as_pairs(met.withColumn("right_source", F.col("left_source")), "intra", kind)


def unordered_key() -> Column:
    return T.unordered_key("l1_norm", "l2_norm", "l3_norm")


def unordered_exact_cross(df: DataFrame, *, source_order: list[str] | None = None) -> DataFrame:
    """The same set of levels in any order, across sources."""
    return equal_cross(df, unordered_key(), "unordered_exact", source_order)


def unordered_exact_intra(df: DataFrame) -> DataFrame:
    return equal_intra(df, unordered_key(), "unordered_exact")


def l3_l3_cross(df: DataFrame) -> DataFrame:
    """Equal third levels across sources."""
    return equal_cross(df.where(T.usable_level("l3_norm")), F.col("l3_norm"), "l3_exact")


def l2_l3_cross(df: DataFrame) -> DataFrame:
    """A left second level that is a right third level."""
    usable = lambda c: F.when(T.usable_level(c), F.col(c))
    return equal_cross(df, usable("l2_norm"), "l2_l3_exact", right_key=usable("l3_norm"))


def used_ids(pairs: DataFrame) -> DataFrame:
    """(source, id) of everything that is in a pair."""
    return pairs.select(F.col("left_source").alias("source"), F.col("left_id").alias("id")).unionByName(pairs.select(F.col("right_source").alias("source"), F.col("right_id").alias("id"))).distinct()


def unordered_exact_fallback(df: DataFrame, base: DataFrame) -> DataFrame:
    """One-to-one pairs of what ``base`` left unmatched, by the set of the path's parts: the n-th free id of a key on the left with the n-th on the right."""
    free = keyed(df, T.unordered_path_key("path_norm")).join(used_ids(base), ["source", "id"], "left_anti")
    n = F.row_number().over(Window.partitionBy("source", "key").orderBy("id"))
    left, right = sides(free.withColumn("n", n), "source", "id", "n")
    return as_pairs(left.join(right, "key").where("left_n = right_n and left_source < right_source"), "cross", "unordered_exact")


def paths_of(df: DataFrame) -> DataFrame:
    return df.where("source is not null and path_norm is not null").select("source", "path_norm").distinct()


def expanded(found: DataFrame, df: DataFrame, scope: str, kind: str, *, symmetric: bool = False) -> DataFrame:
    """Pairs of paths as pairs of all ids under them. Within a source only left_id < right_id, unless ``symmetric`` puts the smaller id left."""
    ids = df.where("path_norm is not null").select("source", "path_norm", F.col("id").cast("string").alias("id")).distinct()
    l = ids.select(F.col("source").alias("left_source"), F.col("path_norm").alias("left_key"), F.col("id").alias("left_id"))
    r = ids.select(F.col("source").alias("right_source"), F.col("path_norm").alias("right_key"), F.col("id").alias("right_id"))
    met = found.join(l, ["left_source", "left_key"]).join(r, ["right_source", "right_key"])
    if scope == "intra":
        if symmetric:
            met = met.withColumns({"left_id": F.least("left_id", "right_id"), "right_id": F.greatest("left_id", "right_id")})
        met = met.where("left_id < right_id")
    return as_pairs(met, scope, kind, F.col("similarity"))


def _cross_texts(df: DataFrame, blocks: list[str]) -> DataFrame:
    """A row for each path in each pair of sources (and block) that it takes part in."""
    d = df.where("source is not null and path_norm is not null").select("source", "path_norm", *blocks).distinct()
    each = d.select("source", *blocks).distinct()
    l = each.select(F.col("source").alias("left_source"), *blocks)
    r = each.select(F.col("source").alias("right_source"), *blocks)
    fits = (l.join(r, blocks) if blocks else l.crossJoin(r)).where("left_source < right_source").withColumn("fit", F.struct("left_source", "right_source", *blocks))
    texts = [d.join(fits, (d["source"] == fits[f"{side}_source"]) & (F.lit(True) if not blocks else _all_equal(d, fits, blocks))).select("fit", F.lit(side[0]).alias("side"), d["path_norm"].alias("key")) for side in ("left", "right")]
    return texts[0].unionByName(texts[1])


def _all_equal(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (a[c] == b[c])
    return out


def _cross(df: DataFrame, threshold: float, blocks: list[str]) -> DataFrame:
    return tfidf.similar_pairs(_cross_texts(df, blocks), tfidf.char_grams("key"), threshold)


def _named(found: DataFrame) -> DataFrame:
    return found.select("fit.left_source", "fit.right_source", "left_key", "right_key", "similarity")


def tfidf_cross(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """For each left path the most similar right path by character TF-IDF, fitted to each pair of sources, if it reaches the threshold."""
    return expanded(_named(tfidf.best_left(_cross(df, threshold, []))), df, "cross", "tfidf")


def tfidf_cross_mutual(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    """As ``tfidf_cross``, if the paths are each other's best."""
    return expanded(_named(tfidf.mutual_best(_cross(df, threshold, []))), df, "cross", "tfidf")


def block_columns(df: DataFrame, block_by: str) -> tuple[DataFrame, list[str]]:
    """``block_by``: l1 or l1l2."""
    names = {"l1": ["l1_norm"], "l1l2": ["l1_norm", "l2_norm"]}[block_by]
    return df.withColumns({f"block_{n}": F.coalesce(n, F.lit("")) for n in names}), [f"block_{n}" for n in names]


def tfidf_cross_blocked(df: DataFrame, threshold: float = 0.8, block_by: str = "l1") -> DataFrame:
    """As ``tfidf_cross`` within blocks of equal first (and second) level, each with its own document frequencies."""
    blocked, blocks = block_columns(df, block_by)
    found = _named(tfidf.best_left(_cross(blocked, threshold, blocks)))
    best = found.groupBy("left_source", "right_source", "left_key", "right_key").agg(F.max("similarity").alias("similarity"))
    return expanded(best, df, "cross", "tfidf")


def tfidf_intra(df: DataFrame, threshold: float = 0.8, *, symmetric: bool = False) -> DataFrame:
    """All pairs of different paths of one source that reach the threshold."""
    return _intra(df, threshold, [], symmetric)


def tfidf_intra_blocked(df: DataFrame, threshold: float = 0.8, block_by: str = "l1", *, symmetric: bool = False) -> DataFrame:
    blocked, blocks = block_columns(df, block_by)
    return _intra(blocked, threshold, blocks, symmetric)


def _intra(df: DataFrame, threshold: float, blocks: list[str], symmetric: bool) -> DataFrame:
    texts = df.where("source is not null and path_norm is not null").select(F.struct("source", *blocks).alias("fit"), F.col("path_norm").alias("key")).distinct()
    found = tfidf.similar_pairs(texts, tfidf.char_grams("key"), threshold, within=True)
    found = found.select(F.col("fit.source").alias("left_source"), F.col("fit.source").alias("right_source"), "left_key", "right_key", "similarity")
    best = found.groupBy("left_source", "right_source", "left_key", "right_key").agg(F.max("similarity").alias("similarity"))
    return expanded(best, df, "intra", "tfidf", symmetric=symmetric)


def used_paths(df: DataFrame, base: DataFrame) -> DataFrame:
    """(left_source, right_source, path) of the paths whose ids ``base`` pairs, on either side."""
    ids = df.select("source", F.col("id").cast("string").alias("id"), "path_norm").distinct()
    found = None
    for side in ("left", "right"):
        met = base.select("left_source", "right_source", F.col(f"{side}_id").alias("id"), F.col(f"{side}_source").alias("source")).join(ids, ["source", "id"]).select("left_source", "right_source", F.lit(side).alias("side"), F.col("path_norm").alias("path"))
        found = met if found is None else found.unionByName(met)
    return found.distinct()


def cross_perm12_fallback(df: DataFrame, base: DataFrame, *, separator: str = " / ") -> DataFrame:
    """A right path b / a / c for a left path a / b / c, with both unused by ``base``, and one to one."""
    p = paths_of(df).withColumn("parts", T.three_parts("path_norm")).where("parts is not null")
    joined = lambda a, b, c: F.concat_ws(separator, *[F.get("parts", F.lit(k)) for k in (a, b, c)])
    l = p.select(F.col("source").alias("left_source"), F.col("path_norm").alias("left_key"), joined(0, 1, 2).alias("swapped"))
    r = p.select(F.col("source").alias("right_source"), F.col("path_norm").alias("right_key"), joined(1, 0, 2).alias("swapped"), joined(0, 2, 1).alias("shifted"))
    met = l.join(r, "swapped").where("left_source < right_source")
    other = paths_of(df).select(F.col("source").alias("left_source"), F.col("path_norm").alias("shifted"))
    met = met.join(other, ["left_source", "shifted"], "left_anti")
    used = used_paths(df, base)
    for side in ("left", "right"):
        met = met.join(used.where(F.col("side") == side).select("left_source", "right_source", F.col("path").alias(f"{side}_key")), ["left_source", "right_source", f"{side}_key"], "left_anti")
    many = lambda side: F.count(F.lit(1)).over(Window.partitionBy("left_source", "right_source", f"{side}_key"))
    met = met.withColumns({"__l": many("left"), "__r": many("right")}).where("__l = 1 and __r = 1").withColumn("similarity", F.lit(1.0))
    return expanded(met.select("left_source", "right_source", "left_key", "right_key", "similarity"), df, "cross", "perm12_exact")


def best_of_kinds(*found: DataFrame) -> DataFrame:
    """The union, with one row for each pair whichever way round: of the first kind that has it, then the most similar."""
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    w = Window.partitionBy("__key").orderBy(rank_of(), F.desc("similarity"), "left_source", "left_id")
    return union.withColumn("__key", T.pair_key()).withColumn("__n", F.row_number().over(w)).where("__n = 1").select(*PAIR)


def tfidf_cross_with_perm12(df: DataFrame, threshold: float = 0.8, *, separator: str = " / ") -> DataFrame:
    base = cut(tfidf_cross_mutual(df, threshold))  # used several times, and by far the most work
    return best_of_kinds(base, cross_perm12_fallback(df, base, separator=separator))


def tfidf_cross_with_perm12_and_unordered(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    both = cut(tfidf_cross_with_perm12(df, threshold))
    return best_of_kinds(both, unordered_exact_fallback(df, both))


def sorted_neighbourhood(df: DataFrame, window: int = 5, *, run: int = 10_000) -> DataFrame:
    """(source, left_path, right_path): paths of a source less than ``window`` places apart in order.

    Paths are sorted by ranges over all tasks and get their places from the sizes of the ranges
    before. Each task then has ``run`` places of a source, and the first few of the next run.
    """
    order = ["source", "key", "path_norm"]
    sorted_ = cut(paths_of(df).withColumn("key", T.neighbourhood_key("path_norm")).repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_.groupBy("source", "range").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    place = F.col("start") + F.row_number().over(Window.partitionBy("source", "range").orderBy("key", "path_norm")) - 1
    own = F.floor(F.col("place") / F.lit(run)).cast("long")
    placed = sorted_.join(sizes, ["source", "range"]).withColumn("place", place).withColumn("own", own)
    runs = F.when((F.col("place") % run < window - 1) & (F.col("own") > 0), F.array("own", F.col("own") - 1)).otherwise(F.array("own"))
    ahead = Window.partitionBy("source", "run").orderBy("place")
    near = placed.select("source", "path_norm", "place", "own", F.explode(runs).alias("run")).withColumn("near", F.array(*[F.lead("path_norm", k).over(ahead) for k in range(1, window)])).where("own = run")
    return near.select("source", F.col("path_norm").alias("left_path"), F.explode("near").alias("right_path")).where("right_path is not null")


def combined(*found: DataFrame) -> DataFrame:
    """The union of generators, each pair of one type once."""
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    return union.groupBy("left_source", "right_source", "left_id", "right_id", "match_scope", "match_type").agg(F.max("similarity").alias("similarity")).select(*PAIR)


def _levels_by_id(df: DataFrame) -> DataFrame:
    from linkloom.operators.normalize import first_by_id

    blank = [F.when(F.trim(F.coalesce(F.col(c), F.lit(""))) != "", F.col(c)) for c in ("l1_norm", "l2_norm", "l3_norm")]
    return first_by_id(df.select(F.col("id").cast("string").alias("id"), "category_id", F.filter(F.array(*blank), lambda x: x.isNotNull()).alias("levels"))).select("id", "levels")


def _with_levels(pairs: DataFrame, df: DataFrame) -> DataFrame:
    levels = _levels_by_id(df)
    for side in ("left", "right"):
        pairs = pairs.join(levels.select(F.col("id").alias(f"{side}_id"), F.col("levels").alias(f"__{side}")), f"{side}_id", "left")
    return pairs


def drop_intra_parent_child(pairs: DataFrame, df: DataFrame) -> DataFrame:
    """Without pairs of one source where one path begins with the other; pairs of unknown ids stay."""
    p = _with_levels(pairs, df)
    longer = F.when(F.size("__left") > F.size("__right"), F.col("__left")).otherwise(F.col("__right"))
    shorter = F.when(F.size("__left") > F.size("__right"), F.col("__right")).otherwise(F.col("__left"))
    related = (F.size("__left") != F.size("__right")) & (F.size(shorter) > 0) & (F.slice(longer, F.lit(1), F.greatest(F.size(shorter), F.lit(0))) == shorter)
    return p.where(~((F.col("match_scope") == "intra") & F.coalesce(related, F.lit(False)))).select(*pairs.columns)


def drop_different_last_child(pairs: DataFrame, df: DataFrame) -> DataFrame:
    """Only pairs whose last levels are equal (or both absent); pairs of unknown ids stay."""
    p = _with_levels(pairs, df)
    last = lambda c: F.try_element_at(F.col(c), F.lit(-1))
    return p.where(F.col("__left").isNull() | F.col("__right").isNull() | last("__left").eqNullSafe(last("__right"))).select(*pairs.columns)
