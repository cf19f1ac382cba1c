"""DuckDB SQL for the registered queries, written independently of the operators."""

from __future__ import annotations

THRESHOLD = 0.8
PAIR = "left_source, right_source, left_id, right_id, similarity, match_scope, match_type"

RAW = """raw AS (
  SELECT CAST(p_partkey AS VARCHAR) AS category_id, source,
    CASE WHEN p_partkey % 7 = 0 THEN upper(a) WHEN p_partkey % 5 = 0 THEN a || 's' WHEN p_partkey % 19 = 0 THEN 'Infused ' || a ELSE a END AS level_one, b AS level_two,
    CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 17 = 0 THEN '' ELSE p_name END AS level_three,
    strftime(DATE '2025-01-01' + CAST(p_size AS INTEGER), '%Y-%m-%d') AS updated_at
  FROM (SELECT *, CASE WHEN p_partkey % 2 = 1 THEN 'right' ELSE 'left' END AS source,
      CASE WHEN p_partkey % 2 = 1 AND p_partkey % 11 = 0 THEN p_brand ELSE p_type END AS a,
      CASE WHEN p_partkey % 2 = 1 AND p_partkey % 11 = 0 THEN p_type WHEN p_partkey % 2 = 0 AND p_partkey % 23 = 0 THEN p_name ELSE p_brand END AS b FROM part))"""


def _clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _single(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^.{{4,}}s$') AND NOT regexp_matches({x}, '(ss|is|us)$') AND {x} NOT IN ('glass', 'cannabis', 'press', 'mass', 'boss', 'class') THEN left({x}, length({x}) - 1) ELSE {x} END"


NORM = RAW + f""", f AS (SELECT category_id, source, coalesce(level_one, 'uncategorized') AS level_one, coalesce(level_two, 'uncategorized') AS level_two, coalesce(level_three, 'uncategorized') AS level_three, updated_at FROM raw),
f1 AS (SELECT *, {_clean('level_one')} AS x0, {_clean('level_two')} AS y, {_clean('level_three')} AS z FROM f),
f2 AS (SELECT *, CASE x0 WHEN 'pre roll' THEN 'pre-roll' WHEN 'vapes' THEN 'vape pen' ELSE x0 END AS x FROM f1),
f3 AS (SELECT *, {_single('x')} AS s1, {_single('y')} AS l2_norm, {_single('z')} AS l3_norm FROM f2),
n AS (SELECT category_id, source, level_one, level_two, level_three, updated_at, starts_with(s1, 'infused ') AS is_infused,
  CASE WHEN starts_with(s1, 'infused ') THEN trim(substr(s1, 9)) ELSE s1 END AS l1_norm, l2_norm, l3_norm,
  concat_ws(' / ', nullif(replace(CASE WHEN starts_with(s1, 'infused ') THEN trim(substr(s1, 9)) ELSE s1 END, '-', ' '), ''), nullif(replace(l2_norm, '-', ' '), ''), nullif(replace(l3_norm, '-', ' '), '')) AS path_norm,
  md5(concat_ws('|', 'v1', source, {', '.join(f"trim(regexp_replace(lower({c}), '\\s+', ' ', 'g'))" for c in ('level_one', 'level_two', 'level_three'))})) AS id FROM f3),
k AS (SELECT *, array_to_string(list_sort(list_distinct(list_filter([trim(l1_norm), trim(l2_norm), trim(l3_norm)], lambda v: v <> ''))), '||') AS ukey,
  array_to_string(list_sort(list_distinct(list_filter([trim(v) FOR v IN string_split(path_norm, '/')], lambda v: v <> ''))), '||') AS pkey FROM n)"""


def _equal(name: str, left: str, right: str, kind: str, scope: str = "cross", where: str = "TRUE") -> str:
    order = "l.source < r.source" if scope == "cross" else "l.source = r.source AND l.id < r.id"
    return f"{name} AS (SELECT DISTINCT l.source AS left_source, r.source AS right_source, l.id AS left_id, r.id AS right_id, CAST(1.0 AS DOUBLE) AS similarity, '{scope}' AS match_scope, '{kind}' AS match_type FROM k l JOIN k r ON l.{left} = r.{right} AND {order} WHERE {where})"


def _usable(x: str) -> str:
    return f"{x} <> '' AND {x} <> 'uncategorized'"


EXACT = _equal("exact", "path_norm", "path_norm", "exact")
EXACT_INTRA = _equal("exact_intra", "path_norm", "path_norm", "exact", "intra")
UNORDERED = _equal("unordered", "ukey", "ukey", "unordered_exact")
UNORDERED_INTRA = _equal("unordered_intra", "ukey", "ukey", "unordered_exact", "intra")
L3 = _equal("l3", "l3_norm", "l3_norm", "l3_exact", where=_usable("l.l3_norm"))
L2L3 = _equal("l2l3", "l2_norm", "l3_norm", "l2_l3_exact", where=_usable("l.l2_norm"))
COMBINED = f"{EXACT}, {L3}, {L2L3}, c AS (SELECT * FROM exact UNION SELECT * FROM l3 UNION SELECT * FROM l2l3)"
INTRA = f"{EXACT_INTRA}, {UNORDERED_INTRA}, c AS (SELECT * FROM exact_intra UNION SELECT * FROM unordered_intra)"


def _used(base: str) -> str:
    return f"used AS (SELECT left_source AS source, left_id AS id FROM {base} UNION SELECT right_source, right_id FROM {base})"


def _fallback(base: str) -> str:
    return f"""{_used(base)}, free AS (SELECT *, row_number() OVER (PARTITION BY source, pkey ORDER BY id) AS ord_ FROM (SELECT DISTINCT source, id, pkey FROM k) WHERE (source, id) NOT IN (SELECT (source, id) FROM used)),
fallback AS (SELECT l.source AS left_source, r.source AS right_source, l.id AS left_id, r.id AS right_id, CAST(1.0 AS DOUBLE) AS similarity, 'cross' AS match_scope, 'unordered_exact' AS match_type FROM free l JOIN free r ON l.pkey = r.pkey AND l.ord_ = r.ord_ AND l.source < r.source)"""


def _perm(base: str) -> str:
    return f"""paths AS (SELECT DISTINCT source, path_norm, string_split(path_norm, ' / ') AS p FROM k),
usedpath AS (SELECT DISTINCT x.left_source, x.right_source, 'l' AS side, k.path_norm FROM {base} x JOIN k ON k.source = x.left_source AND k.id = x.left_id UNION SELECT DISTINCT x.left_source, x.right_source, 'r', k.path_norm FROM {base} x JOIN k ON k.source = x.right_source AND k.id = x.right_id),
cand AS (SELECT l.source AS left_source, r.source AS right_source, l.path_norm AS lp, r.path_norm AS rp FROM paths l JOIN paths r ON len(l.p) = 3 AND len(r.p) = 3 AND l.p[1] = r.p[2] AND l.p[2] = r.p[1] AND l.p[3] = r.p[3] AND l.source < r.source
  WHERE NOT EXISTS (SELECT 1 FROM paths q WHERE q.source = l.source AND q.path_norm = concat_ws(' / ', r.p[1], r.p[3], r.p[2]))
  AND NOT EXISTS (SELECT 1 FROM usedpath u WHERE u.left_source = l.source AND u.right_source = r.source AND u.side = 'l' AND u.path_norm = l.path_norm)
  AND NOT EXISTS (SELECT 1 FROM usedpath u WHERE u.left_source = l.source AND u.right_source = r.source AND u.side = 'r' AND u.path_norm = r.path_norm)),
once AS (SELECT * FROM cand QUALIFY count(*) OVER (PARTITION BY left_source, right_source, lp) = 1 AND count(*) OVER (PARTITION BY left_source, right_source, rp) = 1),
perm AS (SELECT DISTINCT o.left_source, o.right_source, l.id AS left_id, r.id AS right_id, CAST(1.0 AS DOUBLE) AS similarity, 'cross' AS match_scope, 'perm12_exact' AS match_type FROM once o JOIN k l ON l.source = o.left_source AND l.path_norm = o.lp JOIN k r ON r.source = o.right_source AND r.path_norm = o.rp)"""


def _cosines(texts: str) -> str:
    """CTEs from texts (fit, side, key) to cosines (fit, lk, rk, s); ``texts`` defines the first."""
    return f"""texts AS ({texts}), w AS (SELECT fit, side, key, unnest(string_split(key, ' ')) AS w FROM texts),
g AS (SELECT fit, side, key, substring(' ' || w || ' ', i.i, m.m) AS gram, count(*) AS tf FROM (SELECT * FROM w WHERE w <> '') JOIN (VALUES (3), (4), (5)) m(m) ON m.m <= length(w) + 2 JOIN (SELECT unnest(range(1, 80)) AS i) i ON i.i <= length(w) + 3 - m.m GROUP BY ALL),
d AS (SELECT fit, gram, count(*) AS df FROM g GROUP BY ALL), nn AS (SELECT fit, count(*) AS n FROM texts GROUP BY ALL),
v0 AS (SELECT g.*, tf * (ln((1 + n) / (1 + df)) + 1) AS x FROM g JOIN d USING (fit, gram) JOIN nn USING (fit)),
v AS (SELECT fit, side, key, gram, x / sqrt(sum(x * x) OVER (PARTITION BY fit, side, key)) AS x FROM v0)"""


LR = "s AS (SELECT l.fit, l.key AS lk, r.key AS rk, round(sum(l.x * r.x), 9) AS s FROM v l JOIN v r ON l.fit = r.fit AND l.gram = r.gram AND l.side = 'l' AND r.side = 'r' GROUP BY ALL)"
LL = "s AS (SELECT l.fit, l.key AS lk, r.key AS rk, round(sum(l.x * r.x), 9) AS s FROM v l JOIN v r ON l.fit = r.fit AND l.gram = r.gram AND l.key < r.key GROUP BY ALL)"


def _cross_texts(block: str) -> str:
    return f"SELECT DISTINCT {block} AS fit, CASE WHEN source = 'left' THEN 'l' ELSE 'r' END AS side, path_norm AS key FROM k WHERE {block} IN (SELECT {block} FROM k WHERE source = 'left') AND {block} IN (SELECT {block} FROM k WHERE source = 'right')"


def _tfidf_cross(threshold: float, block: str = "''", mutual: bool = False) -> str:
    second = " AND row_number() OVER (PARTITION BY fit, rk ORDER BY s DESC, lk) = 1" if mutual else ""
    return f"""{_cosines(_cross_texts(block))}, {LR},
best AS (SELECT lk, rk, max(s) AS s FROM (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY fit, lk ORDER BY s DESC, rk) = 1{second}) WHERE s >= {threshold} GROUP BY ALL),
t AS (SELECT DISTINCT 'left' AS left_source, 'right' AS right_source, l.id AS left_id, r.id AS right_id, s AS similarity, 'cross' AS match_scope, 'tfidf' AS match_type FROM best JOIN k l ON l.source = 'left' AND l.path_norm = lk JOIN k r ON r.source = 'right' AND r.path_norm = rk)"""


def _tfidf_intra(threshold: float, block: str = "''") -> str:
    return f"""{_cosines(f"SELECT DISTINCT {{'s': source, 'b': {block}}} AS fit, 'l' AS side, path_norm AS key FROM k")}, {LL},
best AS (SELECT fit.s AS source, lk, rk, max(s) AS s FROM s WHERE s >= {threshold} GROUP BY ALL),
t AS (SELECT DISTINCT b.source AS left_source, b.source AS right_source, l.id AS left_id, r.id AS right_id, b.s AS similarity, 'intra' AS match_scope, 'tfidf' AS match_type FROM best b JOIN k l ON l.source = b.source AND l.path_norm = lk JOIN k r ON r.source = b.source AND r.path_norm = rk WHERE l.id < r.id)"""


ROUNDED = PAIR.replace("similarity", "round(similarity, 6) AS similarity")
RANK = "CASE match_type WHEN 'exact' THEN 0 WHEN 'tfidf' THEN 1 WHEN 'perm12_exact' THEN 2 WHEN 'unordered_exact' THEN 3 WHEN 'l3_exact' THEN 4 ELSE 5 END"
NAN = ", ".join(f"CASE WHEN trim({c}) = '' THEN 'nan' ELSE {c} END" for c in ("level_one", "level_two", "level_three"))
FIRST = f"first AS (SELECT id, category_id, updated_at, concat_ws(' / ', {NAN}) AS path FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY category_id) = 1)"
PRETTY = f"{FIRST}, cp AS (SELECT c.*, l.path AS left_path_pretty, r.path AS right_path_pretty FROM c LEFT JOIN first l ON l.id = left_id LEFT JOIN first r ON r.id = right_id)"
KEY = "array_to_string(list_sort([left_source || '::' || left_id, right_source || '::' || right_id]), '|')"


def _level(path: str, k: int) -> str:
    x = f"trim(string_split({path}, '/')[{k}])"
    return f"CASE WHEN lower({x}) NOT IN ('', 'nan', 'none', 'null', 'uncategorized') THEN {x} END"


def _levels(path: str) -> str:
    return ", ".join(f"{_level(path, k)} AS {c}" for k, c in enumerate(("level_one", "level_two", "level_three"), 1))


def _n_levels(path: str) -> str:
    return "(" + " + ".join(f"(({_level(path, k)}) IS NOT NULL)::INTEGER" for k in (1, 2, 3)) + ")"


RESOLVED = f"""{COMBINED}, {PRETTY}, p1 AS (SELECT *, {KEY} AS pk FROM cp QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY round(similarity, 9) DESC, {RANK}, left_source, left_id) = 1),
p2 AS (SELECT * FROM p1 QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY round(similarity, 9) DESC, pk) = 1),
res AS (SELECT left_id AS id, l.category_id, {_levels('left_path_pretty')}, left_source AS source, left_path_pretty AS pretty_path, right_path_pretty AS dropped_pretty_path, right_source AS dropped_source, right_id AS dropped_id, r.category_id AS dropped_category_id, l.updated_at, similarity AS pair_similarity, match_type AS pair_match_type FROM p2 LEFT JOIN first l ON l.id = left_id LEFT JOIN first r ON r.id = right_id)"""

REACH = f"""{INTRA}, {PRETTY}, e AS (SELECT DISTINCT left_source AS source, left_id AS a, right_id AS b FROM c UNION SELECT DISTINCT left_source, right_id, left_id FROM c),
reach AS (SELECT source, a, b FROM e UNION SELECT r.source, r.a, e.b FROM reach r JOIN e ON e.source = r.source AND e.a = r.b),
comp AS (SELECT source, a AS id, least(a, min(b)) AS root FROM reach GROUP BY source, a)"""

MEMBERS = f"""{REACH}, m AS (SELECT c.source, c.root, c.id, f.category_id, f.updated_at, f.path, row_number() OVER (PARTITION BY c.source, c.root ORDER BY {_n_levels('f.path')} DESC, f.updated_at DESC, c.id) AS ord_ FROM comp c JOIN first f ON f.id = c.id),
both_ AS (SELECT w.id, w.category_id, {_levels('w.path')}, w.source, w.path AS pretty_path, x.path AS dropped_pretty_path, w.source AS dropped_source, x.id AS dropped_id, x.category_id AS dropped_category_id, w.updated_at, 'most_complete_then_newest' AS intra_policy FROM m w JOIN m x ON w.source = x.source AND w.root = x.root AND w.ord_ = 1 AND x.ord_ > 1)"""


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(ctes) + " "


UNIQ = "array_to_string(list_sort(list_distinct(list_filter([upper(regexp_replace(x, '[^A-Za-z]', '', 'g')) FOR x IN regexp_split_to_array(states, '[,|;/\\s]+')], lambda x: x <> ''))), ',')"
SUFFIX = ", ".join(f"'{x}'" for x in ["inc", "co", "corp", "corporation", "llc", "ltd", "gmbh", "s.a.", "sa", "bv", "ag", "plc", "pte", "oy", "srl", "spa", "k.k.", "kk"])


def _brand(x: str) -> str:
    return f"nullif(array_to_string(list_filter(string_split({_clean(f'replace(replace({x}, chr(38), chr(32)||chr(97)||chr(110)||chr(100)||chr(32)), chr(43), chr(32)||chr(97)||chr(110)||chr(100)||chr(32))')}, ' '), lambda w: w NOT IN ({SUFFIX})), ' '), '')"


PRODUCTS = f"""pp AS (SELECT CAST(p_partkey AS VARCHAR) AS product_key, p_partkey, p_brand, p_size, p_name || ' ' || p_size || CASE p_size % 3 WHEN 0 THEN 'g' WHEN 1 THEN ' mg' ELSE ' fl oz' END AS product_name,
  CASE WHEN p_size % 4 = 0 THEN 'short' ELSE p_type || ' ' || p_name END AS description, CASE p_size % 4 WHEN 0 THEN 'indica' WHEN 1 THEN 'hybrid' WHEN 2 THEN 'unknown' END AS strain_type_norm,
  CASE p_size % 3 WHEN 0 THEN 'ca, NY;tx' WHEN 1 THEN 'wa' ELSE '' END AS states, CASE p_size % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'MEXICO' END AS country_norm FROM part),
unit AS (SELECT *, CASE p_size % 5 WHEN 0 THEN 'gram' WHEN 1 THEN 'mg' WHEN 2 THEN 'oz' WHEN 3 THEN 'ml' ELSE 'each' END AS own, CASE p_size % 3 WHEN 0 THEN 'gram' WHEN 1 THEN 'mg' ELSE 'fl oz' END AS named FROM pp),
feed AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN named ELSE own END AS uom_norm FROM unit WHERE p_partkey % 2 = 0),
prod AS (SELECT product_key, 'feed' AS source, {_brand("p_brand || ' Inc'")} AS brand_name_norm, {_clean('product_name')} AS product_name_norm, CASE WHEN length({_clean('description')}) < 10 THEN {_clean('product_name')} ELSE {_clean('description')} END AS description_norm, uom_norm,
  CASE WHEN uom_norm = 'each' THEN 'each' ELSE CAST(CAST(round_even(p_size * CASE uom_norm WHEN 'gram' THEN 1000.0 WHEN 'mg' THEN 1.0 WHEN 'oz' THEN 28000.0 WHEN 'ml' THEN 1000.0 ELSE 29573.5 END, 0) AS BIGINT) AS VARCHAR) || '-milligrams' END AS measure_mg,
  strain_type_norm, nullif({UNIQ}, '') AS states_norm, country_norm FROM feed
 UNION ALL SELECT product_key, 'listing', {_brand('p_brand')}, {_clean('product_name')}, CASE WHEN length({_clean('description')}) < 10 THEN {_clean('product_name')} ELSE {_clean('description')} END, 'gram', CAST(p_size * 1000 AS VARCHAR), strain_type_norm, nullif({UNIQ}, ''), country_norm FROM unit WHERE p_partkey % 2 = 1)"""


def _block(name: str, threshold: float, top: int, right: str = "TRUE") -> str:
    return f"""{name} AS (SELECT * FROM (SELECT l.product_key AS left_key, r.product_key AS right_key, l.brand_name_norm, len(list_intersect(l.t, r.t)) / (len(l.t) + len(r.t) - len(list_intersect(l.t, r.t))) AS name_jaccard FROM tk l JOIN tk r ON l.brand_name_norm = r.brand_name_norm AND l.source = 'listing' AND r.source = 'feed' AND {right})
 WHERE name_jaccard >= {threshold} QUALIFY row_number() OVER (PARTITION BY left_key ORDER BY name_jaccard DESC, right_key) <= {top})"""


TOKENS = "tk AS (SELECT *, list_distinct(string_split(product_name_norm, ' ')) AS t FROM prod)"
CAND = f"{PRODUCTS}, {TOKENS}, {_block('cand', 0.35, 300)}"
MG = "CASE WHEN {0} IN ('', 'each') THEN NULL ELSE TRY_CAST(regexp_replace({0}, '-milligrams$', '') AS BIGINT) END"
MATCHED = f"""{CAND}, pm AS (SELECT c.*, l.source AS left_source, r.source AS right_source, l.brand_name_norm AS left_brand_name, r.brand_name_norm AS right_brand_name, l.product_name_norm AS left_product_name, r.product_name_norm AS right_product_name, l.uom_norm AS left_uom, r.uom_norm AS right_uom, l.measure_mg AS left_measure_mg, r.measure_mg AS right_measure_mg,
  {MG.format('l.measure_mg')} AS lm, {MG.format('r.measure_mg')} AS rm FROM cand c JOIN prod l ON l.product_key = left_key JOIN prod r ON r.product_key = right_key)"""
MATCH = "left_key, right_key, left_source, right_source, left_brand_name, right_brand_name, left_product_name, right_product_name, left_uom, right_uom, left_measure_mg, right_measure_mg, similarity, match_type"


def _fit(name: str, grams: str) -> str:
    return f"""{name}g AS ({grams}), {name}d AS (SELECT gram, count(*) AS df FROM {name}g GROUP BY ALL), {name}0 AS (SELECT g.key, g.gram, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1) AS x FROM {name}g g JOIN {name}d USING (gram)),
{name}v AS (SELECT key, gram, x / sqrt(sum(x * x) OVER (PARTITION BY key)) AS x FROM {name}0),
{name}s AS (SELECT left_key, right_key, sum(l.x * r.x) AS s FROM cand JOIN {name}v l ON l.key = left_key JOIN {name}v r ON r.key = right_key AND r.gram = l.gram GROUP BY ALL)"""


_WORDS = "list_filter(regexp_extract_all(product_name_norm, '\\w+'), lambda x: length(x) > 1)"
PRODUCT_TFIDF = f"""{MATCHED}, docs AS (SELECT product_key AS key, product_name_norm, {_WORDS} AS ws FROM prod WHERE product_key IN (SELECT left_key FROM cand UNION SELECT right_key FROM cand)),
{_fit('aa', "SELECT key, array_to_string(list_slice(ws, i.i, i.i + m.m - 1), ' ') AS gram, count(*) AS tf FROM docs JOIN (VALUES (1), (2), (3)) m(m) ON m.m <= len(ws) JOIN (SELECT unnest(range(1, 40)) AS i) i ON i.i + m.m - 1 <= len(ws) GROUP BY ALL")},
{_fit('bb', "SELECT key, substring(' ' || w || ' ', i.i, m.m) AS gram, count(*) AS tf FROM (SELECT key, unnest(string_split(product_name_norm, ' ')) AS w FROM docs) JOIN (VALUES (3), (4), (5)) m(m) ON m.m <= length(w) + 2 JOIN (SELECT unnest(range(1, 60)) AS i) i ON i.i <= length(w) + 3 - m.m WHERE w <> '' GROUP BY ALL")}"""


def oracle_sql() -> dict[str, str]:
    k = lambda *ctes, **o: _with(NORM, *ctes, **o)
    both = f"{EXACT}, {EXACT_INTRA}, c AS (SELECT * FROM exact UNION SELECT * FROM exact_intra)"
    summary = "roles AS (SELECT left_id AS id, left_source AS source, right_id AS p, match_scope FROM c UNION SELECT right_id, right_source, left_id, match_scope FROM c), su AS (SELECT id, source, count(*) FILTER (match_scope = 'intra') AS intra_count, count(*) FILTER (match_scope = 'cross') AS cross_count FROM roles GROUP BY ALL)"
    levels = "lv AS (SELECT id, list_filter([l1_norm, l2_norm, l3_norm], lambda v: trim(v) <> '') AS levels FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY category_id) = 1)"
    l1, l12 = "{'a': l1_norm}", "{'a': l1_norm, 'b': l2_norm}"
    kinds = f"(SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {RANK}, similarity DESC, left_source, left_id) AS ord_ FROM "
    every = f"{_tfidf_cross(THRESHOLD, mutual=True)}, {_perm('t')}, tp AS (SELECT {PAIR} FROM {kinds}(SELECT * FROM t UNION ALL SELECT * FROM perm)) WHERE ord_ = 1), {_fallback('tp')}"
    return {
        "normalize_categories": k() + "SELECT category_id, source, level_one, level_two, level_three, l1_norm, l2_norm, l3_norm, is_infused, path_norm, id, updated_at FROM n",
        "pretty_paths": _with(RAW, f"q AS (SELECT category_id, concat_ws(' / ', {', '.join(f'''CASE WHEN trim(coalesce({c}, '')) = '' THEN 'nan' ELSE {c} END''' for c in ('level_one', 'level_two', 'level_three'))}) AS path_pretty FROM raw)") + f"SELECT *, {_n_levels('path_pretty')} AS n_levels FROM q",
        "uuid_md5": "SELECT p_partkey, regexp_replace(md5(p_name), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS uid FROM part",
        "exact_cross": k(EXACT) + "SELECT * FROM exact",
        "exact_intra": k(EXACT_INTRA) + "SELECT * FROM exact_intra",
        "unordered_exact_cross": k(UNORDERED) + "SELECT * FROM unordered",
        "unordered_exact_intra": k(UNORDERED_INTRA) + "SELECT * FROM unordered_intra",
        "unordered_fallback": k(EXACT, _fallback("exact")) + "SELECT * FROM fallback",
        "perm12": k(EXACT, _perm("exact")) + "SELECT * FROM perm",
        "l3_l3": k(L3) + "SELECT * FROM l3",
        "l2_l3": k(L2L3) + "SELECT * FROM l2l3",
        "tfidf_cross": k(_tfidf_cross(THRESHOLD)) + f"SELECT {ROUNDED} FROM t",
        "tfidf_mutual": k(_tfidf_cross(THRESHOLD, mutual=True)) + f"SELECT {ROUNDED} FROM t",
        "tfidf_intra": k(_tfidf_intra(THRESHOLD)) + f"SELECT {ROUNDED} FROM t",
        "tfidf_blocked_l1": k(_tfidf_cross(THRESHOLD, l1)) + f"SELECT {ROUNDED} FROM t",
        "tfidf_blocked_l1l2": k(_tfidf_cross(THRESHOLD, l12)) + f"SELECT {ROUNDED} FROM t",
        "tfidf_intra_blocked": k(_tfidf_intra(THRESHOLD, "l1_norm")) + f"SELECT {ROUNDED} FROM t",
        "tfidf_with_perm12_and_unordered": k(every) + f"SELECT {ROUNDED} FROM {kinds}(SELECT * FROM tp UNION ALL SELECT * FROM fallback)) WHERE ord_ = 1",
        "pairs_combined": k(COMBINED) + "SELECT * FROM c",
        "pairs_with_paths": k(COMBINED, PRETTY) + "SELECT * FROM cp",
        "parent_child_filter": k(_tfidf_intra(0.7, l12), levels) + f"SELECT {ROUNDED} FROM t JOIN lv a ON a.id = left_id JOIN lv b ON b.id = right_id WHERE NOT (len(a.levels) <> len(b.levels) AND least(len(a.levels), len(b.levels)) > 0 AND a.levels[1:least(len(a.levels), len(b.levels))] = b.levels[1:least(len(a.levels), len(b.levels))])",
        "last_child_filter": k(UNORDERED, L2L3, levels) + f"SELECT {PAIR} FROM (SELECT * FROM unordered UNION SELECT * FROM l2l3) JOIN lv a ON a.id = left_id JOIN lv b ON b.id = right_id WHERE a.levels[-1] IS NOT DISTINCT FROM b.levels[-1]",
        "sorted_neighbourhood": k("o AS (SELECT source, path_norm, row_number() OVER (PARTITION BY source ORDER BY regexp_replace(path_norm, '[\\s/\\-&]+', '', 'g'), path_norm) AS ord_ FROM (SELECT DISTINCT source, path_norm FROM k))") + "SELECT l.source, l.path_norm AS left_path, r.path_norm AS right_path FROM o l JOIN o r ON l.source = r.source AND r.ord_ BETWEEN l.ord_ + 1 AND l.ord_ + 4",
        "summary_per_category": k(both, summary) + "SELECT *, intra_count > 0 AS has_intra, cross_count > 0 AS has_cross FROM su",
        "pairs_with_flags": k(both, summary) + f"SELECT {PAIR}, " + ", ".join(f"coalesce({s}.{x}_count, 0) AS {w}_{x}_count, coalesce({s}.{x}_count, 0) > 0 AS {w}_has_{x}" for s, w in (("a", "left"), ("b", "right")) for x in ("intra", "cross")) + " FROM c LEFT JOIN su a ON a.id = left_id AND a.source = left_source LEFT JOIN su b ON b.id = right_id AND b.source = right_source",
        "similarity_stats": k(_tfidf_cross(0.6, l1)) + "SELECT count(*) AS n, round(min(similarity), 6) AS min_similarity, round(max(similarity), 6) AS max_similarity, round(avg(similarity), 6) AS mean_similarity, round(stddev_pop(similarity), 6) AS std_similarity FROM t",
        "counts_by_type": k(COMBINED) + "SELECT match_scope, match_type, count(*) AS n FROM c GROUP BY ALL",
        "paths_per_source": k() + "SELECT source, count(*) AS n_rows, count(DISTINCT path_norm) AS n_paths, count(DISTINCT id) AS n_ids FROM k GROUP BY ALL",
        "sample_topn": k(COMBINED) + "SELECT * FROM c ORDER BY match_scope, match_type, similarity DESC, left_id, right_id, left_source, right_source LIMIT 2000",
        "cross_resolution": k(RESOLVED) + "SELECT * FROM res",
        "winner_policy": k(COMBINED, PRETTY) + f"SELECT left_id, right_id, match_type, CASE WHEN {_n_levels('left_path_pretty')} <> {_n_levels('right_path_pretty')} THEN {_n_levels('left_path_pretty')} > {_n_levels('right_path_pretty')} ELSE 's' || left_source < 's' || right_source END AS left_wins FROM cp",
        "intra_components": k(REACH, recursive=True) + "SELECT source, id, root FROM comp",
        "intra_pairwise": k(MEMBERS, recursive=True) + "SELECT * FROM both_",
        "intra_resolution": k(MEMBERS, recursive=True) + "SELECT id, category_id, level_one, level_two, level_three, source, pretty_path, string_agg(dropped_pretty_path, ' | ' ORDER BY dropped_id) AS dropped_pretty_path, dropped_source, string_agg(dropped_id, ' | ' ORDER BY dropped_id) AS dropped_id, string_agg(dropped_category_id, ' | ' ORDER BY dropped_id) AS dropped_category_id, updated_at, intra_policy FROM both_ GROUP BY ALL",
        "global_id_map": k(RESOLVED, "e AS (SELECT dropped_id AS id, max(id) AS par FROM res WHERE dropped_id <> id GROUP BY 1)", "ch AS (SELECT id, par AS anchor, 1 AS depth FROM e UNION ALL SELECT ch.id, e.par, depth + 1 FROM ch JOIN e ON e.id = ch.anchor)", "an AS (SELECT id, arg_max(anchor, depth) AS anchor FROM ch GROUP BY id)", "newest AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC, category_id, source) = 1)", recursive=True) + "SELECT regexp_replace(md5(coalesce(anchor, id)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS global_id, category_id, source, updated_at FROM newest LEFT JOIN an USING (id)",
        "anchor_chain": "WITH RECURSIVE e AS (SELECT p_partkey AS id, p_partkey - p_partkey % 7 - 1 AS par FROM part WHERE p_partkey - p_partkey % 7 - 1 > 0), ch AS (SELECT id, par AS ord_ FROM e UNION ALL SELECT ch.id, e.par FROM ch JOIN e ON e.id = ch.ord_) SELECT CAST(id AS VARCHAR) AS id, CAST(ord_ AS VARCHAR) AS anchor FROM ch WHERE ord_ NOT IN (SELECT id FROM e)",
        "contract_defaults": "SELECT p_partkey AS key, CASE p_partkey % 3 WHEN 1 THEN CAST(p_partkey AS VARCHAR) ELSE '' END AS category_id, CASE p_partkey % 4 WHEN 1 THEN 'g1' ELSE '' END AS global_id, CASE WHEN p_partkey % 5 < 3 THEN '2025-06-01' ELSE '2025-02-03' END AS updated_at, md5('v1|left|' || lower(p_type) || '|' || lower(p_brand) || '|') AS id FROM part",
        "left_right_union": "SELECT c_custkey AS key, c_nationkey AS nation, CAST(NULL AS VARCHAR) AS name, 'left' AS match_side FROM customer UNION ALL SELECT s_suppkey, NULL, s_name, 'right' FROM supplier",
        "mapping_left_join": "SELECT c_custkey AS category_id, c_name, o_orderkey AS global_id FROM customer LEFT JOIN orders ON o_custkey = c_custkey",
        "filtered_scan": "SELECT p_partkey, p_name, 'test_source' AS source FROM part WHERE p_brand = 'Brand#23'",
        "product_normalize": _with(PRODUCTS) + "SELECT * FROM prod",
        "uom_to_mg": "WITH u AS (SELECT p_partkey AS key, CASE WHEN p_partkey % 11 <> 0 THEN p_size / 4 END AS m, ['gram', 'gram', 'mg', 'oz', 'oz', 'ml', 'fl oz', 'each', 'ml', 'box'][p_partkey % 10 + 1] AS unit FROM part) SELECT key, unit, CASE WHEN unit = 'each' THEN 'each' WHEN unit = 'box' THEN NULL ELSE CAST(CAST(round_even(m * CASE unit WHEN 'gram' THEN 1000.0 WHEN 'mg' THEN 1.0 WHEN 'oz' THEN 28000.0 WHEN 'ml' THEN 1000.0 ELSE 29573.5 END, 0) AS BIGINT) AS VARCHAR) || '-milligrams' END AS measure_mg FROM u",
        "measure_from_name": "SELECT p_partkey AS key, round(CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS DOUBLE) WHEN 1 THEN p_size + 0.5 WHEN 2 THEN 1.0 / p_size WHEN 3 THEN CAST(p_size AS DOUBLE) END, 6) AS value, CASE p_partkey % 6 WHEN 0 THEN 'mg' WHEN 1 THEN 'gram' WHEN 2 THEN 'oz' WHEN 3 THEN 'fl oz' END AS unit FROM part",
        "brand_normalize": "SELECT p_partkey, " + _clean("replace(p_brand, '#', ' ')") + " || CASE WHEN p_size % 2 = 0 THEN ' and' ELSE ' and sons' END AS brand FROM part",
        "strain_states_country": _with(PRODUCTS) + "SELECT product_key, strain_type_norm, states_norm, country_norm FROM prod WHERE source = 'feed'",
        "brand_fill": "SELECT CAST(p_partkey AS VARCHAR) AS product_key, 'b' || substring(p_brand, 7, 4) AS brand_id, p_brand AS brand_name FROM part WHERE p_partkey % 2 = 1",
        "token_frequencies": _with(PRODUCTS) + "SELECT token, count(*) AS df FROM (SELECT unnest(list_distinct(string_split(product_name_norm, ' '))) AS token FROM prod) GROUP BY ALL",
        "product_block": _with(CAND) + "SELECT left_key, right_key, brand_name_norm, round(name_jaccard, 6) AS name_jaccard FROM cand",
        "product_block_multipass": _with(PRODUCTS, TOKENS, _block("one", 0.6, 300), _block("two", 0.35, 300, "r.product_key NOT IN (SELECT right_key FROM one)")) + "SELECT left_key, right_key, brand_name_norm, round(name_jaccard, 6) AS name_jaccard FROM (SELECT * FROM one UNION ALL SELECT * FROM two)",
        "product_exact": _with(MATCHED) + f"SELECT {MATCH}, round(name_jaccard, 6) AS pair_name_score FROM (SELECT *, CAST(1.0 AS DOUBLE) AS similarity, 'exact' AS match_type FROM pm) WHERE left_brand_name = right_brand_name AND left_product_name = right_product_name AND (coalesce(trim(left_uom), '') = '' OR coalesce(trim(right_uom), '') = '' OR left_uom = right_uom AND lm IS NOT DISTINCT FROM rm)",
        "product_tfidf": _with(PRODUCT_TFIDF) + f"SELECT {MATCH} FROM (SELECT pm.*, round(sc, 4) AS similarity, 'tfidf' AS match_type, sc FROM (SELECT pm.*, 0.8 * coalesce(x.s, 0) + 0.2 * coalesce(y.s, 0) AS sc FROM pm LEFT JOIN aas x USING (left_key, right_key) LEFT JOIN bbs y USING (left_key, right_key)) pm WHERE lm IS NULL OR rm IS NULL OR lm = rm) WHERE round(sc, 9) >= 0.6",
    }
