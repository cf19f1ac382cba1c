"""From pairs to winners, and from winners to global identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators.lineage import cut
from linkloom.operators.normalize import LEVELS, category_contract, first_by_id
from linkloom.operators.pairs import rank_of

RESOLUTION = ["id", "category_id", *LEVELS, "source", "pretty_path", "dropped_pretty_path", "dropped_source", "dropped_id", "dropped_category_id", "updated_at", "pair_similarity", "pair_match_type"]
INTRA = [*RESOLUTION[:12], "intra_policy"]
POLICY = "most_complete_then_newest"


def left_wins(policy: str) -> Column:
    """Whether a pair's left side is kept. ``left``: always. ``most_complete``: sources named left and right as such, else more levels, smaller source, smaller id."""
    if policy == "left":
        return F.lit(True)
    if policy != "most_complete":
        raise ValueError("policy is left or most_complete")
    ls, rs = (F.lower(F.trim(F.coalesce(f"{s}_source", F.lit("")))) for s in ("left", "right"))
    lc, rc = (T.count_levels(f"{s}_path_pretty") for s in ("left", "right"))
    named = F.when((ls == "left") & (rs == "right"), True).when((ls == "right") & (rs == "left"), False)
    by_size = F.when(lc != rc, lc > rc)
    by_source = F.when(F.col("left_source") != F.col("right_source"), F.col("left_source") < F.col("right_source"))
    return F.coalesce(named, by_size, by_source, F.col("left_id") <= F.col("right_id"))


def with_levels(df: DataFrame, path: str) -> DataFrame:
    return df.withColumns({c: F.get(T.levels_of(path), F.lit(k)) for k, c in enumerate(LEVELS)})


def cross_resolution(pairs: DataFrame, cats: DataFrame, *, as_of: str, policy: str = "left") -> DataFrame:
    """One row for each kept id: the partner that it replaces, the best of those it has.

    Needs left_path_pretty and right_path_pretty. Similarities count to 9 digits, so that float
    noise doesn't decide between kinds of match.
    """
    absent = [c for c in ("left_path_pretty", "right_path_pretty") if c not in pairs.columns]
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    p = pairs.where("match_scope = 'cross'").withColumns({"__key": T.pair_key(), "__s": F.round("similarity", 9)})
    best = Window.partitionBy("__key").orderBy(F.desc("__s"), rank_of(), "left_source", "left_id")
    p = p.withColumn("__n", F.row_number().over(best)).where("__n = 1").withColumn("__left", left_wins(policy))
    side = lambda c, kept: F.when(F.col("__left") == kept, F.col(f"left_{c}")).otherwise(F.col(f"right_{c}"))
    p = p.select("__key", "__s", side("id", True).alias("id"), side("source", True).alias("source"), side("path_pretty", True).alias("pretty_path"), side("id", False).alias("dropped_id"), side("source", False).alias("dropped_source"), side("path_pretty", False).alias("dropped_pretty_path"), F.col("similarity").alias("pair_similarity"), F.col("match_type").alias("pair_match_type"))
    one = Window.partitionBy("id").orderBy(F.desc("__s"), "__key")
    p = with_levels(p.withColumn("__n", F.row_number().over(one)).where("__n = 1"), "pretty_path")
    return _with_categories(p, cats, as_of).select(*RESOLUTION)


def _with_categories(df: DataFrame, cats: DataFrame, as_of: str) -> DataFrame:
    known = first_by_id(category_contract(cats, as_of=as_of).select("id", "category_id", "updated_at"))
    df = df.join(known, "id", "left").join(known.select(F.col("id").alias("dropped_id"), F.col("category_id").alias("dropped_category_id")), "dropped_id", "left")
    return df.withColumns({"category_id": F.coalesce("category_id", F.lit("")), "dropped_category_id": F.coalesce("dropped_category_id", F.lit("")), "updated_at": F.coalesce("updated_at", F.lit(as_of).cast("timestamp"))})


def components(edges: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """(source, id, root): of each id in the edges (source, a, b), the smallest id that it is connected with in its source.

    Large-star and small-star contraction in turn: rounds grow with the logarithm of a
    component's size, and each round's edges are written to the checkpoint folder.
    """
    now = cut(edges.select("source", F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    last = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select("source", F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("source", "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, ["source", "u"]).select("source", F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("source", "u").agg(F.min("v").alias("m"))
        now = cut(large.join(least, ["source", "u"]).select("source", F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("source", "u", "v").cast("decimal(38,0)"))).first())
        if state == last:
            return now.select("source", F.col("u").alias("id"), F.col("v").alias("root")).unionByName(now.select("source", F.col("v").alias("id"), F.col("v").alias("root")).distinct())
        last = state
    raise RuntimeError(f"components didn't settle within {most_rounds} rounds")


def intra_resolution(pairs: DataFrame, cats: DataFrame, *, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(aggregated, pairwise): in each component of pairs within a source the most complete, then newest, then smallest id is kept; one row for each kept id, or for each dropped one."""
    p = pairs.where("match_scope = 'intra'")
    comp = components(p.select(F.col("left_source").alias("source"), F.col("left_id").alias("a"), F.col("right_id").alias("b")))
    paths = p.select(F.explode(F.array(*[F.struct(F.col("left_source").alias("source"), F.col(f"{s}_id").alias("id"), F.col(f"{s}_path_pretty").alias("path")) for s in ("left", "right")])).alias("x")).select("x.*").groupBy("source", "id").agg(F.min("path").alias("path"))
    known = first_by_id(category_contract(cats, as_of=as_of).select("id", "category_id", "updated_at"))
    m = comp.join(paths, ["source", "id"]).join(known, "id", "left").withColumns({"category_id": F.coalesce("category_id", F.lit("")), "updated_at": F.coalesce("updated_at", F.lit(as_of).cast("timestamp"))})
    w = Window.partitionBy("source", "root").orderBy(F.desc(T.count_levels("path")), F.desc("updated_at"), "id")
    m = m.withColumn("__n", F.row_number().over(w))
    kept = with_levels(m.where("__n = 1").select("source", "root", "id", "category_id", F.col("path").alias("pretty_path"), "updated_at"), "pretty_path")
    gone = m.where("__n > 1").select("source", "root", F.col("id").alias("dropped_id"), F.col("category_id").alias("dropped_category_id"), F.col("path").alias("dropped_pretty_path"))
    pairwise = kept.join(gone, ["source", "root"]).withColumns({"dropped_source": F.col("source"), "intra_policy": F.lit(POLICY)})
    in_order = F.array_sort(F.collect_list(F.struct("dropped_id", "dropped_category_id", "dropped_pretty_path")))
    group = [c for c in INTRA if not c.startswith("dropped") or c == "dropped_source"]
    agg = pairwise.groupBy("root", *group).agg(in_order.alias("x"))
    joined = {c: F.array_join(F.filter(F.col("x")[c], lambda v: v.isNotNull()), " | ") for c in ("dropped_id", "dropped_category_id", "dropped_pretty_path")}
    return agg.withColumns(joined).select(*INTRA), pairwise.select(*INTRA)


def _followed(edges: DataFrame, rounds: int) -> DataFrame:
    """(id, to) after at most 2**rounds steps, by doubling; an id without an edge stays where it is."""
    now = edges
    for _ in range(rounds):
        jump = now.select(F.col("id").alias("to"), F.col("to").alias("__further"))
        stepped = now.join(jump, "to", "left").select("id", F.coalesce("__further", "to").alias("next"), (F.col("__further").isNotNull() & (F.col("__further") != F.col("to"))).alias("moved"))
        stepped = cut(stepped)
        moved = stepped.where("moved").limit(1).count()
        now = stepped.select("id", F.col("next").alias("to"))
        if not moved:
            break
    return now


def anchors(edges: DataFrame) -> DataFrame:
    """(id, anchor) for each id with an edge (dropped_id, id): the end of its chain.

    An id on a cycle is its own anchor, and a chain that leads to a cycle ends where it enters.
    After as many steps as there are edges, what still moves is on a cycle, and every id of a
    cycle is the place of some id.
    """
    e = cut(edges.where("dropped_id is not null and id is not null and dropped_id <> id").groupBy("dropped_id").agg(F.max("id").alias("to")).select(F.col("dropped_id").alias("id"), "to"))
    n = e.count()
    rounds = max(1, math.ceil(math.log2(max(2, n))) + 1)
    ends = _followed(e, rounds)
    looping = cut(ends.join(e.select(F.col("id").alias("to")), "to", "left_semi").select(F.col("to").alias("id")).distinct())
    if looping.isEmpty():
        return ends.select("id", F.col("to").alias("anchor"))
    straight = _followed(cut(e.join(looping, "id", "left_anti")), rounds)
    return straight.select("id", F.col("to").alias("anchor")).unionByName(looping.select("id", F.col("id").alias("anchor")))


def global_id_map(resolution: DataFrame, cats: DataFrame, *, as_of: str) -> DataFrame:
    """(global_id, category_id, source, updated_at) for each id, its newest row.

    An id has the global id of its anchor: the one that the anchor has already, else a UUID made
    of the anchor's id. If several ids dropped one, the largest of them counts.
    """
    c = category_contract(cats, as_of=as_of).select("id", "category_id", "global_id", "source", "updated_at")
    w = Window.partitionBy("id").orderBy(F.desc("updated_at"), "category_id", "source")
    c = c.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    a = anchors(resolution.select("dropped_id", "id"))
    own = c.where("global_id <> ''").select(F.col("id").alias("anchor"), F.col("global_id").alias("__known"))
    c = c.join(a, "id", "left").withColumn("anchor", F.coalesce("anchor", "id")).join(own, "anchor", "left")
    return c.select(F.coalesce("__known", T.uuid_of("anchor")).alias("global_id"), "category_id", F.coalesce(F.trim("source"), F.lit("")).alias("source"), "updated_at")
