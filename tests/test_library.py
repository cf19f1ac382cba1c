"""Operators against hand-made cases, and registered queries against their SQL on the smallest tables."""

import difflib
import math
import os
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.__main__ import main
from linkloom.functions import products as PF
from linkloom.functions import text as T
from linkloom.operators import pairs as G
from linkloom.operators import products as P
from linkloom.operators import resolve, tfidf
from linkloom.operators.normalize import category_contract, normalize_categories, with_match_side
from linkloom.oracle import oracle_sql
from linkloom.plans import categories as plan
from linkloom.queries import queries
from linkloom.sources import readers, writers

SF = "/root/testdata/sf0.001"
AS_OF = "2025-06-01 00:00:00"
CATS = "id string, category_id string, source string, level_one string, level_two string, level_three string, updated_at string"
PAIRS = G.PAIR_SQL + ", left_path_pretty string, right_path_pretty string"


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column).first()[0]


def rows(df):
    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "customer", "supplier", "orders", "documents"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    found = con.sql(oracle_sql()[name])
    order = sorted(range(len(found.columns)), key=lambda k: found.columns[k])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df) == sorted((tuple(round(r[k], 6) if isinstance(r[k], float) else r[k] for k in order) for r in found.fetchall()), key=repr)


@pytest.mark.parametrize("text,want", [("  Pré-Rolls & Co. ", "pre rolls co"), (None, ""), ("½ ß_x", "1 2 ß_x"), ("", "")])
def test_normalize_text(spark, text, want):
    assert one(spark, T.normalize_text("x"), text) == want


@pytest.mark.parametrize("text,want", [("flowers", "flower"), ("glass", "glass"), ("tinctures ", "tincture"), ("basis", "basis"), ("gas", "gas"), ("abcs", "abcs"), ("cacti us", "cacti us")])
def test_singular(spark, text, want):
    assert one(spark, T.singular("x"), text) == want


@pytest.mark.parametrize("path,n", [("Flowers/Indica/Purple", 3), ("Flowers/Indica", 2), ("Flowers", 1), ("uncategorized", 0), ("", 0), (None, 0)])
def test_count_levels(spark, path, n):
    assert one(spark, T.count_levels("x"), path) == n


def test_uuid_and_row_id(spark):
    assert len(one(spark, T.uuid_of("x"), "a")) == 36
    assert len(one(spark, T.row_id("x", "x", "x", "x"), " A  b ")) == 32
    assert one(spark, T.ascii_lower("x"), " A  B ") == "a b"


def test_match_side_replaces_source(spark):
    r = with_match_side(spark.createDataFrame([("v1", "left")], "source string, match_side string")).first()
    assert (r["source"], r["source_raw"]) == ("left", "v1")


@pytest.mark.parametrize("value", [None, "", "invalid", "NaT", "2025-13-99"])
def test_contract_fills_timestamps_and_columns(spark, value):
    r = category_contract(spark.createDataFrame([("x", value)], "some_col string, updated_at string"), as_of=AS_OF).first()
    assert str(r["updated_at"]) == AS_OF and len(r["id"]) == 32 and r["category_id"] == ""


def test_nulls_in_levels_and_infused(spark):
    raw = spark.createDataFrame([("1", "c", "s", "Infused Pre Rolls", None, "", None)], CATS)
    r = normalize_categories(raw, as_of=AS_OF).first()
    assert (r["l1_norm"], r["l2_norm"], r["l3_norm"], r["is_infused"]) == ("pre roll", "uncategorized", "", True)
    assert r["path_norm"] == "pre roll / uncategorized"


def pair(left, right, similarity=1.0, scope="cross", kind="exact", sources=("left", "right")):
    return (*sources, left, right, similarity, scope, kind, "Flower/Indica", "Flower/Indica")


def test_resolution_and_shared_global_id(spark):
    cats = spark.createDataFrame([(i, i, s, "Flower", "Indica", "Purple", "2025-01-01") for i, s in (("L1", "left"), ("R1", "right"), ("R2", "right"))], CATS)
    found = spark.createDataFrame([pair("L1", "R1", 0.8, kind="tfidf"), pair("L1", "R1"), pair("L1", "R2", 0.9)], PAIRS)
    res = resolve.cross_resolution(found, cats, as_of=AS_OF).collect()
    assert [(r["id"], r["dropped_id"], r["pair_match_type"]) for r in res] == [("L1", "R1", "exact")]
    ids = {r["category_id"]: r["global_id"] for r in resolve.global_id_map(resolve.cross_resolution(found, cats, as_of=AS_OF), cats, as_of=AS_OF).collect()}
    assert ids["L1"] == ids["R1"] != ids["R2"]
    known = cats.withColumn("global_id", F.when(F.col("id") == "L1", "gid-left").otherwise(""))
    ids = {r["category_id"]: r["global_id"] for r in resolve.global_id_map(resolve.cross_resolution(found, known, as_of=AS_OF), known, as_of=AS_OF).collect()}
    assert ids["R1"] == "gid-left"


def test_empty_pairs_resolve_to_nothing(spark):
    cats, found = spark.createDataFrame([], CATS), spark.createDataFrame([], PAIRS)
    res = resolve.cross_resolution(found, cats, as_of=AS_OF)
    assert res.columns == resolve.RESOLUTION and res.count() == 0
    assert [x.count() for x in resolve.intra_resolution(found, cats, as_of=AS_OF)] == [0, 0]


def test_intra_resolution_keeps_the_newest(spark):
    cats = spark.createDataFrame([(i, i, "s", "A", "B", "", d) for i, d in (("a", "2025-01-01"), ("b", "2025-01-03"), ("c", "2025-01-02"))], CATS)
    found = spark.createDataFrame([pair("a", "b", scope="intra", sources=("s", "s")), pair("b", "c", scope="intra", sources=("s", "s"))], PAIRS)
    agg, each = resolve.intra_resolution(found, cats, as_of=AS_OF)
    assert [(r["id"], r["dropped_id"]) for r in agg.collect()] == [("b", "a | c")]
    assert {r["dropped_id"] for r in each.collect()} == {"a", "c"}


def test_anchors_with_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("t", "u"), ("u", "x"), ("s", "s")]
    found = {r["id"]: r["anchor"] for r in resolve.anchors(spark.createDataFrame(edges, "dropped_id string, id string")).collect()}
    assert found == {"a": "c", "b": "c", "x": "x", "y": "y", "t": "x", "u": "x"}


@pytest.mark.parametrize("l,r,sources,want", [("A/B/C", "A", ("v", "w"), True), ("A", "A", ("v", "w"), True), ("A", "A/B", ("right", "left"), False), ("A", "A/B", ("left", "right"), True)])
def test_winner_policy(spark, l, r, sources, want):
    df = spark.createDataFrame([(*sources, "1", "2", l, r)], "left_source string, right_source string, left_id string, right_id string, left_path_pretty string, right_path_pretty string")
    assert df.select(resolve.left_wins("most_complete")).first()[0] is want


def test_sequence_ratio_and_measures(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(P.sequence_ratio("a", "b")).collect()] == [0.75, 0.0]
    assert one(spark, P.milligram_value("x"), "3500-milligrams") == 3500
    assert one(spark, P.milligram_value("x"), "250 mg") == 250
    assert one(spark, P.milligram_value("x"), "each") is None


def test_grams(spark):
    assert one(spark, tfidf.word_grams("x", 3), "red anvil a gear") == ["red", "anvil", "gear", "red anvil", "anvil gear", "red anvil gear"]
    assert one(spark, tfidf.word_grams("x", 3), "one") == ["one"] and one(spark, tfidf.word_grams("x", 3), "") == []
    assert one(spark, tfidf.char_grams("x"), "ab c") == [" ab", "ab ", " ab ", " c "]


def test_product_text(spark):
    assert one(spark, PF.normalize_text("x"), "<b>Café</b> &amp; Co! https://x.y z ß") == "cafe co z"
    assert one(spark, PF.normalize_brand("x"), "Müller & Söhne, LLC") == "muller and sohne"
    assert one(spark, PF.normalize_states("x"), "ca, NY;ca") == "CA,NY"
    assert one(spark, PF.list_literal("x"), "['B', 'a', '']") == ["a", "b"]


def test_product_scorers_on_no_pairs(spark):
    norm = P.normalize_products(spark.createDataFrame([("x", "b", "1", "g")], "product_name string, brand_name string, measure string, uom string"), None)
    none = spark.createDataFrame([], "left_key string, right_key string, brand_name_norm string, name_jaccard double")
    assert P.fuzzy_matches(norm, none).columns == P.MATCH and P.fuzzy_matches(norm, none).count() == 0


def test_csv_keeps_blanks_and_dates_are_checked(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,\n,2\n")
    assert rows(readers.csv_strings(spark, str(tmp_path / "x.csv"))) == [("", "2"), ("1", "")]
    assert readers.date_prefix("2025-01-31") == "20250131"
    with pytest.raises(ValueError):
        readers.date_prefix("20251399")


def test_publish(spark, tmp_path):
    mapping = spark.createDataFrame([("g", "c", "s", "2025-01-01")], "global_id string, category_id string, source string, updated_at string")
    out = writers.publish_categories(spark, str(tmp_path), {"mapping": mapping}, stage="test", upload_to=str(tmp_path / "up"))
    assert out["mapping"].endswith("test_categories_id_mapping.parquet") and spark.read.parquet(out["mapping_upload"]).count() == 1


def test_sorted_neighbourhood_over_several_runs(spark):
    paths = [(s, f"{a} / {b}") for s in ("left", "right") for a in "abcdefg" for b in ("x", "y", "z z", "zz")]
    df = spark.createDataFrame(paths, "source string, path_norm string").withColumn("id", F.col("path_norm"))
    whole = rows(G.sorted_neighbourhood(df, 4))
    assert rows(G.sorted_neighbourhood(df, 4, run=5)) == whole and len(whole) == 2 * (25 * 3 + 2 + 1)


def test_run_from_queries_with_snapshot_latest_and_mirror(spark, tmp_path):
    cats = [(i, s, "Flower", "Indica", i[1], "2025-01-01") for s in ("left", "right") for i in (f"{s[0].upper()}1", f"{s[0].upper()}2")]
    spark.createDataFrame(cats, "category_id string, source string, level_one string, level_two string, level_three string, updated_at string").createOrReplaceTempView("cats")
    args = ["categories", "--kind", "left_right", "--left-sql", "select * from cats where source = 'left'", "--right-sql", "select * from cats where source = 'right'", "--as-of", AS_OF, "--out", str(tmp_path / "runs"), "--snapshot", str(tmp_path / "snap"), "--use-snapshot", "--include-intra", "--intra-filter", "last_child", "--perm12", "--mirror-to", str(tmp_path / "copy")]
    first = main([*args, "--name", "one"], spark)
    spark.sql("create or replace temp view cats as select * from values ('x') t(source)")
    second = main([*args, "--name", "two"], spark)  # from the snapshot, as the view has no such columns now
    assert spark.read.parquet(first["pairs"]).count() == spark.read.parquet(second["pairs"]).count() >= 2
    assert os.path.realpath(tmp_path / "runs" / "latest") == str(tmp_path / "runs" / "two")
    assert {x.name for x in (tmp_path / "copy").iterdir()} == {"one", "two", "latest"} and (tmp_path / "copy" / "latest" / "metrics.json").exists()
    with pytest.raises(SystemExit):
        main(["categories", "--kind", "query", "--as-of", AS_OF, "--out", "x"], spark)


def test_intra_filters(spark):
    cats = [(i, i, "s", *x, None) for i, x in (("a", ("Flower", "Indica", "")), ("b", ("Flower", "Indica", "Kush")), ("c", ("Indica", "Flower", "")))]
    norm = normalize_categories(spark.createDataFrame(cats, CATS), as_of=AS_OF)
    n = {k: plan.generate_pairs(norm, plan.CategoryConfig(AS_OF, threshold=0.5, include_intra=True, intra_filter=k)).where("match_scope = 'intra'").select("left_id", "right_id").distinct().count() for k in plan.INTRA_FILTERS}
    assert n["none"] > n["parent_child"] and n["none"] > n["last_child"]


def test_kept_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert P.kept(df, ["b", "zz", "a"]).columns == ["b", "a"]


def test_product_fuzzy_query_against_plain_scores(spark):
    from linkloom import queries as Q

    larger = "/root/testdata/sf0.01"  # no pair reaches the threshold in the smallest tables
    norm, pairs = Q.blocked(spark, larger)
    known = {r["product_key"]: r for r in norm.collect()}

    def mg(x):
        x = (x or "").strip().lower()
        m = re.fullmatch(r"(\d+)\s*-\s*milligrams|(\d+)\s*mg", x)
        if x in ("", "each", "nan") or m:
            return int(m[1] or m[2]) if m else None
        try:
            return round(float(x))
        except ValueError:
            return None

    want = []
    for r in pairs.collect():
        a, b = known[r["left_key"]], known[r["right_key"]]
        l, m = mg(a["measure_mg"]), mg(b["measure_mg"])
        if l is not None and m is not None and l != m:
            continue
        unit = (a["uom_norm"] or "").strip()
        names = a["product_name_norm"] or "", b["product_name_norm"] or ""
        score = 0.8 * difflib.SequenceMatcher(None, *names).ratio() + 0.05 * (unit != "" and unit == (b["uom_norm"] or "").strip()) + 0.1 * (0.5 if l is None or m is None else 1)
        if score >= 0.75:
            want.append((r["left_key"], r["right_key"], round(score, 4)))
    found = [(r["left_key"], r["right_key"], r["similarity"]) for r in queries()["product_fuzzy"](spark, larger).collect()]
    assert sorted(found) == sorted(want) and want


def test_texts_of_a_batch_are_not_held_at_once():
    import tracemalloc

    texts = pa.array([None, "", *["é" * 4000 + str(k) for k in range(500)], None])
    held, most = 0, 0

    class Counted(str):
        def __del__(self):
            nonlocal held
            held -= 1

    def f(t):
        nonlocal held, most
        held += 1
        most = max(most, held)
        return Counted(t.upper())

    assert T.each_text(f).func(texts).to_pylist() == [t and t.upper() for t in texts.to_pylist()] and most <= 2
    assert T.each_text(f).func(texts.slice(1, 0)).to_pylist() == [] and T.each_text(f).func(texts.slice(501)).to_pylist() == ["É" * 4000 + "499", None]
    for g in (T._decomposed.func, PF._to_ascii.func):
        tracemalloc.start()
        g(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 0.75 * texts.nbytes  # before, texts and results were Python strings as well


def repeated_parts(spark, folder, times):
    """The smallest part table repeated with shifted keys."""
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    n = part.count()
    part.crossJoin(spark.range(times).withColumnRenamed("id", "copy")).withColumn("p_partkey", F.col("p_partkey") + F.col("copy") * n).drop("copy").coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


def plain_blocks(known, threshold, top, rights):
    found = []
    for a in known:
        if a["source"] == "listing":
            x = set(a["product_name_norm"].split())
            each = []
            for b in rights:
                y = set(b["product_name_norm"].split())
                j = len(x & y) / len(x | y)
                if a["brand_name_norm"] == b["brand_name_norm"] and j >= threshold:
                    each.append((-j, b["product_key"]))
            found += [(a["product_key"], k, -j) for j, k in sorted(each)[:top]]
    return found


def test_blocking_of_repeated_products_works_on_kinds(spark, tmp_path):
    from linkloom import queries as Q

    norm = Q.products(spark, repeated_parts(spark, tmp_path, 4)).cache()
    known = norm.collect()
    rights = [r for r in known if r["source"] == "feed"]
    plain = lambda df: sorted((r["left_key"], r["right_key"], r["name_jaccard"]) for r in df.collect())
    kinds, members = P.kinds(norm)
    for top in (1, 3):  # fewer than there are, in the midst of kinds and of ties
        want = plain_blocks(known, 0.35, top, rights)
        assert plain(P.blocking_pairs(norm, 0.35, top)) == sorted(want)
        pairs = P.blocking_kinds(kinds, members, 0.35, top)
        assert pairs.count() < len(want)  # pairs of products aren't made before they are asked for
        one = plain_blocks(known, 0.6, top, rights)
        taken = {b for _, b, _ in one}
        two = plain_blocks(known, 0.35, top, [r for r in rights if r["product_key"] not in taken])
        assert plain(P.blocking_pairs_multipass(norm, 0.6, 0.35, top)) == sorted(one + two)


def test_scores_of_kinds_are_those_of_products(spark, tmp_path):
    from linkloom import queries as Q

    norm = Q.products(spark, repeated_parts(spark, tmp_path, 4)).cache()
    kinds, members = P.kinds(norm)
    pairs, each = P.blocking_kinds(kinds, members, 0.2, 5).cache(), P.blocking_pairs(norm, 0.2, 5).cache()
    for score, threshold in ((P.fuzzy_matches, [0.3]), (P.tfidf_matches, [0.1]), (P.exact_matches, [])):
        want = rows(score(norm, each, *threshold))
        assert rows(P.matches_of_kinds(score, kinds, members, pairs, *threshold)) == want and (want or score is P.exact_matches)


def test_sources_read_back_what_was_written(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", "left", "2025-01-01"), ("2", 'say "b", c', "right", "2025-01-02")], "category_id string, level_one string, source string, updated_at string")
    for s in ("left", "right"):
        writers.write_csv(df.where(F.col("source") == s).drop("source"), readers.category_folder(str(tmp_path), s, "2025-01-31"))
    back = readers.dated_categories(spark, str(tmp_path), ["left", "right"], "2025/01/31", renamed={"right": {"level_one": "level_two"}})
    assert rows(back.select("category_id", "source")) == [("1", "left"), ("2", "right")] and back.where("level_two = 'say \"b\", c'").count() == 1
    df.createOrReplaceTempView("written")
    assert rows(readers.table(spark, "written", ["category_id"], "source = 'left'")) == rows(readers.query(spark, "select category_id from written where source = 'left'")) == [("1",)]
    with pytest.raises(ValueError):
        readers.query(spark, "  ")
    calls = []
    for _ in range(2):
        found = readers.snapshot(spark, str(tmp_path / "snap"), lambda: calls.append(1) or df)
    assert len(calls) == 1 and rows(found) == rows(df)
    out = main(["extract", "--sql", "select * from written", "--root", str(tmp_path / "x"), "--source", "s", "--date", "2025-01-31"], spark)
    assert readers.csv_strings(spark, out["path"]).count() == 2
