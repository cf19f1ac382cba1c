"""The library's operators as registered queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions import products as PF
from linkloom.functions import text as T
from linkloom.operators import pairs as G
from linkloom.operators import products as P
from linkloom.operators import resolve, summarize
from linkloom.operators.lineage import cut
from linkloom.operators.normalize import LEVELS, category_contract, normalize_categories
from linkloom.plans import catalog
from linkloom.plans.catalog import AS_OF, table
from linkloom.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
#: Threshold of the registered TF-IDF queries.
THRESHOLD = 0.8


def normalized(s: SparkSession, d: str) -> DataFrame:
    return normalize_categories(catalog.categories(s, d), as_of=AS_OF, unicode=False)


def day(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd"))


def sim(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns or ("similarity",)})


def on_categories(f: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda s, d: sim(f(normalized(s, d), *args, **options))


def equal_pairs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Pairs from equality only, with paths, and their categories: what resolution is tried on."""
    n = normalized(s, d)
    found = G.combined(G.exact_cross(n), G.l3_l3_cross(n), G.l2_l3_cross(n))
    return summarize.attach_pretty_paths(found, n), n


def intra_pairs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = normalized(s, d)
    return summarize.attach_pretty_paths(G.combined(G.exact_intra(n), G.unordered_exact_intra(n)), n), n


def products(s: SparkSession, d: str) -> DataFrame:
    return P.normalize_products(catalog.feed(s, d), catalog.listings(s, d), catalog.brands(s, d), ascii_input=True)


def blocked(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Products and their candidate pairs."""
    p = products(s, d)
    return p, P.blocking_pairs(p, 0.35, 300)


def blocked_kinds(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kinds of products, the products of each, and candidate pairs of kinds."""
    k, members = P.kinds(products(s, d))
    return k, members, cut(P.blocking_kinds(k, members, 0.35, 300))


def chain_edges(s: SparkSession, d: str) -> DataFrame:
    """Every part but the first few is replaced by one up to seven numbers before it."""
    k = F.col("p_partkey")
    return table(s, d, "part").select(k.cast("string").alias("dropped_id"), (k - k % 7 - 1).alias("to")).where("to > 0").select("dropped_id", F.col("to").cast("string").alias("id"))


def contract_rows(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    df = table(s, d, "part").select(
        k.alias("key"),
        F.when(k % 3 == 0, " nan ").when(k % 3 == 1, F.concat(F.lit(" "), k.cast("string"))).alias("category_id"),
        F.when(k % 4 == 0, "None").when(k % 4 == 1, "g1").alias("global_id"),
        F.when(k % 5 == 0, "invalid").when(k % 5 == 1, "2025-13-99").when(k % 5 == 2, "").otherwise("2025-02-03").alias("updated_at"),
        F.lit("left").alias("source"), F.col("p_type").alias("level_one"), F.col("p_brand").alias("level_two"), F.lit(None).cast("string").alias("level_three"),
    )
    return day(category_contract(df, as_of=AS_OF)).select("key", "category_id", "global_id", "updated_at", "id")


def units(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    unit = F.element_at(F.array(*[F.lit(x) for x in ("G", "grams", "mg", "Ounces", "oz", "ml", "fl. oz", "each", "milliliters", "box")]), (k % 10 + 1).cast("int"))
    measure = F.when(k % 11 == 0, "n/a").otherwise((F.col("p_size") / 4).cast("string"))
    u = PF.normalize_unit(unit)
    return table(s, d, "part").select(k.alias("key"), u.alias("unit"), PF.milligrams(PF.number_or_null(measure), u).alias("measure_mg"))


def names(s: SparkSession, d: str) -> DataFrame:
    k, n = F.col("p_partkey"), F.col("p_size").cast("string")
    suffix = F.element_at(F.array(F.concat(n, F.lit("mg")), F.concat(n, F.lit(".5 g")), F.concat(F.lit("1/"), n, F.lit(" oz")), F.concat(n, F.lit(" fl. oz")), F.lit("each"), F.concat(n, F.lit("MLX"))), (k % 6 + 1).cast("int"))
    m = PF.measure_from_name(F.concat_ws(" ", "p_name", suffix))
    return table(s, d, "part").select(k.alias("key"), F.round(m["value"], 6).alias("value"), m["unit"].alias("unit"))


def winner_rows(s: SparkSession, d: str) -> DataFrame:
    p, _ = equal_pairs(s, d)
    # sources without a meaning of their own, so that the rules after it decide
    p = p.withColumns({"left_source": F.concat(F.lit("s"), F.col("left_source")), "right_source": F.concat(F.lit("s"), F.col("right_source"))})
    return p.select("left_id", "right_id", "match_type", resolve.left_wins("most_complete").alias("left_wins"))


def parent_child(s: SparkSession, d: str) -> DataFrame:
    n = normalized(s, d)
    return sim(G.drop_intra_parent_child(G.tfidf_intra_blocked(n, 0.7, "l1l2"), n))


def fallback(s: SparkSession, d: str) -> DataFrame:
    n = normalized(s, d)
    return G.unordered_exact_fallback(n, G.exact_cross(n))


def perm12(s: SparkSession, d: str) -> DataFrame:
    n = normalized(s, d)
    return G.cross_perm12_fallback(n, G.exact_cross(n))


def flags(s: SparkSession, d: str) -> DataFrame:
    n = normalized(s, d)
    found = G.combined(G.exact_cross(n), G.exact_intra(n))
    return summarize.attach_summary_flags(found, summarize.summarize_per_category(found))


def last_child(s: SparkSession, d: str) -> DataFrame:
    n = normalized(s, d)
    return G.drop_different_last_child(G.combined(G.unordered_exact_cross(n), G.l2_l3_cross(n)), n)


def queries() -> dict[str, Query]:
    c = on_categories
    return {
        "normalize_categories": lambda s, d: day(normalized(s, d)).select("category_id", "source", *LEVELS, "l1_norm", "l2_norm", "l3_norm", "is_infused", "path_norm", "id", "updated_at"),
        "pretty_paths": lambda s, d: catalog.categories(s, d).select("category_id", T.pretty_path(*LEVELS).alias("path_pretty"), T.count_levels(T.pretty_path(*LEVELS)).alias("n_levels")),
        "uuid_md5": lambda s, d: table(s, d, "part").select("p_partkey", T.uuid_of("p_name").alias("uid")),
        "exact_cross": c(G.exact_cross),
        "exact_intra": c(G.exact_intra),
        "unordered_exact_cross": c(G.unordered_exact_cross),
        "unordered_exact_intra": c(G.unordered_exact_intra),
        "unordered_fallback": fallback,
        "perm12": perm12,
        "l3_l3": c(G.l3_l3_cross),
        "l2_l3": c(G.l2_l3_cross),
        "tfidf_cross": c(G.tfidf_cross, THRESHOLD),
        "tfidf_mutual": c(G.tfidf_cross_mutual, THRESHOLD),
        "tfidf_intra": c(G.tfidf_intra, THRESHOLD),
        "tfidf_blocked_l1": c(G.tfidf_cross_blocked, THRESHOLD, "l1"),
        "tfidf_blocked_l1l2": c(G.tfidf_cross_blocked, THRESHOLD, "l1l2"),
        "tfidf_intra_blocked": c(G.tfidf_intra_blocked, THRESHOLD, "l1"),
        "tfidf_with_perm12_and_unordered": c(G.tfidf_cross_with_perm12_and_unordered, THRESHOLD),
        "pairs_combined": lambda s, d: equal_pairs(s, d)[0].select(*G.PAIR),
        "pairs_with_paths": lambda s, d: equal_pairs(s, d)[0],
        "parent_child_filter": parent_child,
        "last_child_filter": last_child,
        "sorted_neighbourhood": lambda s, d: G.sorted_neighbourhood(normalized(s, d)),
        "summary_per_category": lambda s, d: summarize.summarize_per_category(G.combined(G.exact_cross(normalized(s, d)), G.exact_intra(normalized(s, d)))),
        "pairs_with_flags": flags,
        "similarity_stats": lambda s, d: sim(summarize.similarity_stats(G.tfidf_cross_blocked(normalized(s, d), 0.6, "l1")), "min_similarity", "max_similarity", "mean_similarity", "std_similarity"),
        "counts_by_type": lambda s, d: summarize.counts_by_type(equal_pairs(s, d)[0]),
        "paths_per_source": lambda s, d: summarize.paths_per_source(normalized(s, d)),
        "sample_topn": lambda s, d: summarize.top_sample(equal_pairs(s, d)[0].select(*G.PAIR), 2000),
        "cross_resolution": lambda s, d: day(resolve.cross_resolution(*equal_pairs(s, d), as_of=AS_OF)),
        "winner_policy": winner_rows,
        "intra_components": lambda s, d: resolve.components(intra_pairs(s, d)[0].select(F.col("left_source").alias("source"), F.col("left_id").alias("a"), F.col("right_id").alias("b"))),
        "intra_resolution": lambda s, d: day(resolve.intra_resolution(*intra_pairs(s, d), as_of=AS_OF)[0]),
        "intra_pairwise": lambda s, d: day(resolve.intra_resolution(*intra_pairs(s, d), as_of=AS_OF)[1]),
        "global_id_map": lambda s, d: day(resolve.global_id_map(resolve.cross_resolution(*equal_pairs(s, d), as_of=AS_OF), normalized(s, d), as_of=AS_OF)),
        "anchor_chain": lambda s, d: resolve.anchors(chain_edges(s, d)),
        "contract_defaults": contract_rows,
        "left_right_union": lambda s, d: readers.left_right(table(s, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation")), [table(s, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))]),
        "mapping_left_join": lambda s, d: readers.with_global_ids(table(s, d, "customer").select(F.col("c_custkey").alias("category_id"), "c_name"), table(s, d, "orders").select(F.col("o_custkey").alias("category_id"), F.col("o_orderkey").alias("global_id"))),
        "filtered_scan": lambda s, d: table(s, d, "part").where("p_brand = 'Brand#23'").select("p_partkey", "p_name", F.lit("test_source").alias("source")),
        "product_normalize": products,
        "product_normalize_documents": lambda s, d: table(s, d, "documents").select(F.col("doc_id").alias("key"), PF.normalize_text("text").alias("text_norm"), T.normalize_text("text").alias("category_norm")),
        "uom_to_mg": units,
        "measure_from_name": names,
        "brand_normalize": lambda s, d: table(s, d, "part").select("p_partkey", PF.normalize_brand(F.concat("p_brand", F.when(F.col("p_size") % 2 == 0, " & Co, LLC").otherwise(" + Sons")), ascii_input=True).alias("brand")),
        "strain_states_country": lambda s, d: P.normalize_feed(catalog.feed(s, d), ascii_input=True).select("product_key", "strain_type_norm", "states_norm", "country_norm"),
        "brand_fill": lambda s, d: P.fill_brands(catalog.listings(s, d), catalog.brands(s, d)).select("product_key", "brand_id", "brand_name"),
        "token_frequencies": lambda s, d: P.document_frequencies(products(s, d).select(PF.tokens("product_name_norm").alias("tokens")), "tokens"),
        "product_block": lambda s, d: sim(blocked(s, d)[1], "name_jaccard"),
        "product_block_multipass": lambda s, d: sim(P.blocking_pairs_multipass(products(s, d), 0.6, 0.35, 300), "name_jaccard"),
        "product_exact": lambda s, d: sim(P.matches_of_kinds(P.exact_matches, *blocked_kinds(s, d)), "pair_name_score"),
        "product_fuzzy": lambda s, d: sim(P.matches_of_kinds(P.fuzzy_matches, *blocked_kinds(s, d), 0.75), "pair_name_score"),
        "product_tfidf": lambda s, d: P.matches_of_kinds(P.tfidf_matches, *blocked_kinds(s, d), 0.6).drop("pair_name_score"),
    }
