"""Products: the two normalizers, blocking by brand and shared tokens, and three scorers.

One side is a feed with plain measures, the other a set of listings with weights already in
milligrams; the names of the two sources are parameters. Listings are on the left.
"""

from __future__ import annotations

import difflib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linkloom.functions import products as P
from linkloom.functions.text import blank_to_null
from linkloom.operators import tfidf
from linkloom.operators.lineage import cut
from linkloom.operators.normalize import with_missing

FEED = ["product_name", "description", "measure", "uom", "brand_id", "brand_name", "strain_type", "states", "country"]
LISTINGS = [*FEED, "product_variant_weight_converted_mg", "product_variant_weight_unit", "product_variant_weight_value"]
NORMALIZED = ["product_key", "source", "brand_name_norm", "product_name_norm", "description_norm", "uom_norm", "measure_mg", "strain_type_norm", "states_norm", "country_norm"]
MATCH = ["left_key", "right_key", "left_source", "right_source", "left_brand_name", "right_brand_name", "left_product_name", "right_product_name", "left_uom", "right_uom", "left_measure_mg", "right_measure_mg", "similarity", "match_type", "pair_name_score"]
WEIGHTS = {"name_seq": 0.80, "desc": 0.05, "uom": 0.05, "measure": 0.10}


def with_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """A key from the row's content, with a number for rows that are alike, where there is none yet."""
    if "product_key" in df.columns:
        return df.withColumn("product_key", F.col("product_key").cast("string"))
    digest = F.md5(F.to_json(F.struct(*sorted({"source", *columns}))))
    n = F.row_number().over(Window.partitionBy("__digest").orderBy(F.lit(1)))
    return df.withColumn("__digest", digest).withColumn("product_key", F.concat_ws("-", "__digest", n)).drop("__digest")


def _contract(df: DataFrame, columns: list[str], source: str) -> DataFrame:
    df = with_missing(df, ["source", *columns], None)
    df = df.withColumn("source", F.coalesce(F.lower(blank_to_null("source")), F.lit(source)))
    return with_key(df, columns)


def _common(df: DataFrame, synonyms: dict | None, aliases: dict | None, ascii_input: bool) -> DataFrame:
    text = lambda c: P.apply_synonyms(P.normalize_text(c, ascii_input=ascii_input), synonyms)
    df = df.withColumns({"product_name_norm": text("product_name"), "__d": text("description")})
    return df.withColumns(
        {
            "description_norm": P.description_or_name(F.col("__d"), F.col("product_name_norm")),
            "brand_name_norm": P.normalize_brand("brand_name", aliases, ascii_input=ascii_input),
            "strain_type_norm": P.normalize_strain("strain_type", ascii_input=ascii_input),
            "states_norm": P.normalize_states("states"),
            "country_norm": P.normalize_country("country"),
        }
    )


def normalize_feed(df: DataFrame, *, source: str = "feed", synonyms: dict | None = None, unit_synonyms: dict | None = None, aliases: dict | None = None, factors: dict | None = None, blank_is_null: bool = False, ascii_input: bool = False) -> DataFrame:
    """Feed rows with measures in milligrams. A measure that is null (or blank, with ``blank_is_null``) is read from the name."""
    df = _contract(df, FEED, source)
    measure = blank_to_null("measure") if blank_is_null else F.col("measure").cast("string")
    found = P.measure_from_name("product_name")
    unit = P.normalize_unit("uom", unit_synonyms)
    taken = measure.isNull() & found["value"].isNotNull()
    df = df.withColumns({"__m": F.when(taken, found["value"]).otherwise(P.number_or_null(measure)), "uom_norm": F.when(taken & found["unit"].isin(P.UNITS_FROM_NAME), found["unit"]).otherwise(unit)})
    df = df.withColumn("measure_mg", P.milligrams(F.col("__m"), F.col("uom_norm"), factors))
    return _common(df, synonyms, aliases, ascii_input).select(*NORMALIZED)


def fill_brands(df: DataFrame, brands: DataFrame, *, source: str = "listing") -> DataFrame:
    """Blank brand names from the brand table by brand_id; of repeated ids the last name in order."""
    if "source" in brands.columns:
        brands = brands.where(F.lower(F.trim("source")) == source)
    known = brands.where("external_id is not null").groupBy(F.col("external_id").cast("string").alias("__id")).agg(F.max("name").alias("__name"))
    filled = df.join(known, df["brand_id"].cast("string") == known["__id"], "left")
    return filled.withColumn("brand_name", F.coalesce(blank_to_null("brand_name"), "__name")).drop("__id", "__name")


def normalize_listings(df: DataFrame, brands: DataFrame | None = None, *, source: str = "listing", synonyms: dict | None = None, unit_synonyms: dict | None = None, aliases: dict | None = None, ascii_input: bool = False) -> DataFrame:
    """Listings, whose weight in milligrams stays as it is. Units come from ``uom`` if any row has one, else from the weight's unit: a decision on the whole table, joined as one row."""
    df = _contract(df, LISTINGS, source)
    if brands is not None:
        df = fill_brands(df, brands, source=source)
    any_unit = df.agg(F.coalesce(F.max(F.col("uom").isNotNull()), F.lit(False)).alias("__any"))
    df = df.crossJoin(F.broadcast(any_unit))
    df = df.withColumns({"uom_norm": P.normalize_unit(F.when(F.col("__any"), F.col("uom")).otherwise(F.col("product_variant_weight_unit")), unit_synonyms), "measure_mg": F.col("product_variant_weight_converted_mg").cast("string")})
    return _common(df, synonyms, aliases, ascii_input).select(*NORMALIZED)


def normalize_products(feed: DataFrame | None, listings: DataFrame | None, brands: DataFrame | None = None, **options) -> DataFrame:
    """Both, one after the other."""
    shared = {k: v for k, v in options.items() if k not in ("factors", "blank_is_null")}
    found = [*([normalize_feed(feed, **options)] if feed is not None else []), *([normalize_listings(listings, brands, **shared)] if listings is not None else [])]
    if not found:
        raise ValueError("there are no products")
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def kept(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns asked for, in that order; those that aren't there are left out."""
    return df.select(*[c for c in columns if c in df.columns])


def milligram_value(c: str | Column) -> Column:
    """The number in a measure such as "3500-milligrams", "250 mg" or "250"; null for blanks and "each"."""
    s = F.lower(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")))
    digits = F.regexp_extract(s, r"^(\d+)\s*-\s*milligrams$|^(\d+)\s*mg$", 1)
    short = F.regexp_extract(s, r"^(\d+)\s*mg$", 1)
    plain = F.bround(s.try_cast("double"), 0).try_cast("long")
    return F.when(s.isin("", "each", "nan"), F.lit(None).cast("long")).when(digits != "", digits.try_cast("long")).when(short != "", short.try_cast("long")).otherwise(plain)


def measures_close(a: Column, b: Column, tolerance: float) -> Column:
    """Relative difference within the tolerance; zero only equals zero; what isn't a number passes."""
    close = F.when((a == 0) | (b == 0), a == b).otherwise(F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b)))
    return F.coalesce(close, F.lit(True))


def measure_rule(left: Column, right: Column, tolerance: float, *, parse_units: bool = False) -> Column:
    """Passes without a right measure. Measures with a unit in them aren't numbers, so they pass, unless ``parse_units`` reads them."""
    missing = right.isNull() | F.lower(F.trim(right)).isin("", "each")
    number = milligram_value if parse_units else (lambda c: F.nullif(c.try_cast("double"), F.lit(float("nan"))))
    return missing | measures_close(number(left), number(right), tolerance)


def document_frequencies(df: DataFrame, tokens: str) -> DataFrame:
    """(token, df): in how many rows each token occurs."""
    return df.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))


#: What blocking and scoring can tell of a product, besides its description.
CONTENT = ["source", "brand_name_norm", "product_name_norm", "uom_norm", "measure_mg"]


def kinds(df: DataFrame, *, include_description: bool = False) -> tuple[DataFrame, DataFrame]:
    """A product for each kind, with the kind as its key, and (kind, source, product_key) of all products, both cut to the checkpoint folder.

    Products of a kind have equal content, so they have the same partners and scores: blocking and
    scoring work on kinds, and only their results are spread over products.
    """
    content = [c for c in (*CONTENT, *(["description_norm"] if include_description else [])) if c in df.columns]
    m = df.withColumn("kind", F.unhex(F.md5(F.to_json(F.struct(*content)))))
    one = m.groupBy("kind").agg(*[F.first(c).alias(c) for c in df.columns if c != "product_key"])
    return cut(one.withColumnRenamed("kind", "product_key")), cut(m.select("kind", "source", "product_key"))


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """Partitioned by columns in as many tasks as set: few bytes here make many rows, so small partitions must not be joined to one."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def _with_tokens(df: DataFrame, include_description: bool, limit: int) -> DataFrame:
    t = P.tokens("product_name_norm")
    if include_description:
        t = F.concat(t, F.slice(P.tokens("description_norm"), 1, limit))
    return df.select("product_key", "source", "brand_name_norm", "measure_mg", F.array_distinct(t).alias("tokens")).where("brand_name_norm is not null and size(tokens) > 0")


def _similar_kinds(df: DataFrame, threshold: float, left: str, right: str, measure_tolerance: float, parse_units: bool, include_description: bool, description_tokens: int) -> DataFrame:
    """(left_kind, right_kind, brand_name_norm, name_jaccard) of all kinds that reach the threshold.

    Only tokens of a prefix, rare first, are joined: sets that reach the threshold share one. A
    pair is taken where the first of those meets, so it comes once.
    """
    t = _with_tokens(df, include_description, description_tokens)
    each = t.select("*", F.explode("tokens").alias("token"))
    df_ = each.groupBy("brand_name_norm", "token").agg(F.count(F.lit(1)).alias("df"))
    t = each.join(df_, ["brand_name_norm", "token"]).groupBy("product_key").agg(*[F.first(c).alias(c) for c in ("source", "brand_name_norm", "measure_mg")], F.array_sort(F.collect_list(F.struct("df", "token"))).alias("x"))
    n = F.size("tokens")
    t = t.withColumn("tokens", F.transform("x", lambda e: e["token"]))
    t = t.withColumn("prefix", F.slice("tokens", F.lit(1), (n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)) + 1).cast("int")) if threshold > 0 else F.col("tokens"))
    side = lambda s, name: _spread(t.where(F.col("source") == name).select("brand_name_norm", F.explode("prefix").alias("token"), F.col("product_key").alias(f"{s}_kind"), *[F.col(c).alias(f"{s}_{c}") for c in ("tokens", "prefix", "measure_mg")]), "brand_name_norm", "token")
    met = side("left", left).join(side("right", right), ["brand_name_norm", "token"]).where(F.get(F.array_intersect("left_prefix", "right_prefix"), F.lit(0)) == F.col("token"))
    both = F.size(F.array_intersect("left_tokens", "right_tokens"))
    scored = met.withColumn("name_jaccard", both / (F.size("left_tokens") + F.size("right_tokens") - both)).where(F.col("name_jaccard") >= threshold)
    scored = scored.where(measure_rule(F.col("left_measure_mg"), F.col("right_measure_mg"), measure_tolerance, parse_units=parse_units))
    return scored.select("left_kind", "right_kind", "brand_name_norm", "name_jaccard")


def blocking_kinds(df: DataFrame, members: DataFrame, threshold: float = 0.6, max_per_left: int = 60, *, left: str = "listing", right: str = "feed", measure_tolerance: float = 0.15, parse_units: bool = False, include_description: bool = False, description_tokens: int = 25) -> DataFrame:
    """``blocking_pairs`` of :func:`kinds`: (left_kind, right_kind, brand_name_norm, name_jaccard, right_keys), with those products of the right kind that are among the best of each product of the left one."""
    found = _similar_kinds(df, threshold, left, right, measure_tolerance, parse_units, include_description, description_tokens)
    # of a kind only the first max_per_left keys can be among the best
    by_key = Window.partitionBy("right_kind").orderBy("right_key")
    known = members.where(F.col("source") == right).select(F.col("kind").alias("right_kind"), F.col("product_key").alias("right_key"))
    known = known.withColumn("at", F.row_number().over(by_key)).where(F.col("at") <= max_per_left)
    # nor can more of it than better kinds leave room for
    better = Window.partitionBy("left_kind").orderBy(F.desc("name_jaccard"))
    found = found.join(known.groupBy("right_kind").agg(F.count(F.lit(1)).alias("n")), "right_kind")
    room = max_per_left - F.sum("n").over(better) + F.sum("n").over(Window.partitionBy("left_kind", "name_jaccard"))
    found = found.withColumn("room", room).where("room > 0").drop("n")
    best = Window.partitionBy("left_kind").orderBy(F.desc("name_jaccard"), "right_key")
    met = found.join(known, "right_kind").where("at <= room").select("left_kind", "right_kind", "brand_name_norm", "name_jaccard", "right_key")
    met = _spread(met, "left_kind").withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= max_per_left)
    return met.groupBy("left_kind", "right_kind").agg(F.first("brand_name_norm").alias("brand_name_norm"), F.first("name_jaccard").alias("name_jaccard"), F.collect_list("right_key").alias("right_keys"))


def blocking_kinds_multipass(df: DataFrame, members: DataFrame, threshold: float = 0.6, second_threshold: float = 0.5, max_per_left: int = 60, *, left: str = "listing", right: str = "feed", **options) -> DataFrame:
    """A second pass with another threshold for right products that the first one left out."""
    one = cut(blocking_kinds(df, members, threshold, max_per_left, left=left, right=right, **options))
    rest = members.where(F.col("source") == right).join(one.select(F.explode("right_keys").alias("product_key")).distinct(), "product_key", "left_anti")
    # the right keys of the two passes don't overlap, so no pair of products can be in both
    return one.unionByName(blocking_kinds(df, rest, second_threshold, max_per_left, left=left, right=right, **options))


def of_products(pairs: DataFrame, members: DataFrame, left: str = "listing") -> DataFrame:
    """Pairs with left_kind and right_keys as pairs with left_key and right_key, one for each left product of the kind and each of the keys."""
    known = members.where(F.col("source") == left).select(F.col("kind").alias("left_kind"), F.col("product_key").alias("left_key"))
    met = _spread(pairs, "left_kind").join(_spread(known, "left_kind"), "left_kind")
    return met.withColumn("right_key", F.explode("right_keys"))


def blocking_pairs(df: DataFrame, threshold: float = 0.6, max_per_left: int = 60, *, left: str = "listing", right: str = "feed", include_description: bool = False, **options) -> DataFrame:
    """(left_key, right_key, brand_name_norm, name_jaccard): pairs of one brand whose token sets have a Jaccard similarity of at least ``threshold``, the best ``max_per_left`` for each left product (of ties, the smaller right key)."""
    k, members = kinds(df, include_description=include_description)
    found = blocking_kinds(k, members, threshold, max_per_left, left=left, right=right, include_description=include_description, **options)
    return of_products(found, members, left).select("left_key", "right_key", "brand_name_norm", "name_jaccard")


def blocking_pairs_multipass(df: DataFrame, threshold: float = 0.6, second_threshold: float = 0.5, max_per_left: int = 60, *, left: str = "listing", right: str = "feed", include_description: bool = False, **options) -> DataFrame:
    """A second pass with another threshold for right products that the first one left out."""
    k, members = kinds(df, include_description=include_description)
    found = blocking_kinds_multipass(k, members, threshold, second_threshold, max_per_left, left=left, right=right, include_description=include_description, **options)
    return of_products(found, members, left).select("left_key", "right_key", "brand_name_norm", "name_jaccard")


def _with_products(pairs: DataFrame, df: DataFrame) -> DataFrame:
    kept = df.select("product_key", "source", F.col("brand_name_norm").alias("brand_name"), F.col("product_name_norm").alias("product_name"), F.col("uom_norm").alias("uom"), "measure_mg", F.col("description_norm").alias("description"))
    for s in ("left", "right"):
        pairs = pairs.join(kept.select(F.col("product_key").alias(f"{s}_key"), *[F.col(c).alias(f"{s}_{c}") for c in kept.columns[1:]]), f"{s}_key")
    return pairs


def measure_gate(pairs: DataFrame) -> DataFrame:
    """Drops pairs with different known measures; measure_score is 1 for equal ones, 0.5 where one is missing."""
    l, r = milligram_value("left_measure_mg"), milligram_value("right_measure_mg")
    return pairs.withColumn("measure_score", F.when(l.isNull() | r.isNull(), 0.5).when(l == r, 1.0)).where("measure_score is not null")


@F.arrow_udf(DoubleType())
def sequence_ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    """Ratcliff and Obershelp's similarity; 0 if both texts are empty. Not symmetric."""
    known: dict[tuple, float] = {}
    out = []
    for pair in zip(a.to_pylist(), b.to_pylist()):
        if pair not in known:
            x, y = (t or "" for t in pair)
            known[pair] = difflib.SequenceMatcher(None, x, y).ratio() if x or y else 0.0
        out.append(known[pair])
    return pa.array(out, pa.float64())


def unit_similarity() -> Column:
    l, r = (F.trim(F.coalesce(f"{s}_uom", F.lit(""))) for s in ("left", "right"))
    return F.when((l != "") & (l == r), 1.0).otherwise(0.0)


def units_compatible(l: Column, r: Column) -> Column:
    """Equal, or one is blank."""
    l, r = (F.lower(F.trim(F.coalesce(x, F.lit("")))) for x in (l, r))
    return (l == "") | (r == "") | (l == r)


def fuzzy_matches(df: DataFrame, pairs: DataFrame, threshold: float = 0.6, *, include_description: bool = False, weights: dict[str, float] | None = None) -> DataFrame:
    """Pairs whose weighted sum of name ratio, (description ratio,) unit and measure reaches the threshold. The measure gate comes before any ratio."""
    w = WEIGHTS | (weights or {})
    p = measure_gate(_with_products(pairs, df))
    score = w["name_seq"] * sequence_ratio("left_product_name", "right_product_name") + w["uom"] * unit_similarity() + w["measure"] * F.col("measure_score")
    if include_description:
        score = score + w["desc"] * sequence_ratio("left_description", "right_description")
    found = p.withColumns({"__s": score}).where(F.col("__s") >= F.lit(threshold))
    return found.withColumns({"similarity": F.round("__s", 4), "match_type": F.lit("fuzzy"), "pair_name_score": F.col("name_jaccard")}).select(*MATCH)


def tfidf_matches(df: DataFrame, pairs: DataFrame, threshold: float = 0.8, *, include_description: bool = False, weights: dict[str, float] | None = None, copies: DataFrame | None = None) -> DataFrame:
    """Pairs whose weighted sum of word and character TF-IDF cosines of the names (and of the descriptions) reaches the threshold; fitted once to the products that occur in any pair, each as often as ``copies``, (product_key, copies), has it."""
    w = ({"name": 0.7, "char": 0.2, "desc": 0.1} if include_description else {"name": 0.8, "char": 0.2, "desc": 0.0}) | (weights or {})
    keys = pairs.select(F.explode(F.array("left_key", "right_key")).alias("product_key")).distinct()
    used = df.join(keys, "product_key")
    if copies is not None:
        used = used.join(copies, "product_key")
    used = used.select(F.col("product_key").alias("key"), "product_name_norm", "description_norm", *(["copies"] if copies is not None else []))
    p = measure_gate(_with_products(pairs, df))
    asked = p.select("left_key", "right_key")

    def cosine(grams: Column, name: str) -> DataFrame:
        # one fit over the products themselves, so frequencies are counted on one side and used on both
        return tfidf.cosines(used, grams, asked).withColumnRenamed("similarity", name)

    terms = [("name", tfidf.word_grams("product_name_norm", 3)), ("char", tfidf.char_grams("product_name_norm"))]
    if include_description:
        terms.append(("desc", tfidf.word_grams("description_norm", 2)))
    score = F.lit(0.0)
    for name, grams in terms:
        p = p.join(cosine(grams, f"__{name}"), ["left_key", "right_key"], "left")
        score = score + w[name] * F.coalesce(f"__{name}", F.lit(0.0))
    found = p.withColumn("__s", score).where(F.round("__s", 9) >= F.lit(threshold))
    return found.withColumns({"similarity": F.round("__s", 4), "match_type": F.lit("tfidf"), "pair_name_score": F.round("__name", 4)}).select(*MATCH)


def exact_matches(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs with equal brand and name whose units and measures are equal or blank on a side."""
    p = _with_products(pairs, df)
    same = (F.col("left_brand_name") == F.col("right_brand_name")) & (F.col("left_product_name") == F.col("right_product_name"))
    blank = lambda s: F.coalesce(F.trim(f"{s}_uom"), F.lit("")) == ""
    sized = (F.col("left_uom") == F.col("right_uom")) & milligram_value("left_measure_mg").eqNullSafe(milligram_value("right_measure_mg"))
    return p.where(same & (blank("left") | blank("right") | sized)).withColumns({"similarity": F.lit(1.0), "match_type": F.lit("exact"), "pair_name_score": F.col("name_jaccard")}).select(*MATCH)


def matches_of_kinds(score: Callable[..., DataFrame], df: DataFrame, members: DataFrame, pairs: DataFrame, *args, left: str = "listing", **options) -> DataFrame:
    """What ``score`` (one of the three above) finds in pairs of products, from pairs of their kinds: each pair of kinds is scored once."""
    named = {"left_kind": "left_key", "right_kind": "right_key"}
    if score is tfidf_matches:
        # a fit counts products: those of left kinds that have a partner, and right ones that are one
        lefts = members.where(F.col("source") == left).join(pairs.select(F.col("left_kind").alias("kind")).distinct(), "kind").groupBy("kind").agg(F.count(F.lit(1)).alias("copies"))
        rights = pairs.select(F.col("right_kind").alias("kind"), F.explode("right_keys").alias("product_key")).distinct().groupBy("kind").agg(F.count(F.lit(1)).alias("copies"))
        options["copies"] = cut(lefts.unionByName(rights).withColumnRenamed("kind", "product_key"))
    found = score(df, pairs.drop("right_keys").withColumnsRenamed(named), *args, **options)
    found = found.withColumnsRenamed({v: k for k, v in named.items()}).join(pairs.select(*named, "right_keys"), list(named))
    return of_products(found, members, left).select(*MATCH)


def by_similarity(matches: DataFrame) -> DataFrame:
    """Most similar first, with a total order."""
    return matches.orderBy(F.desc("similarity"), "left_key", "right_key")
