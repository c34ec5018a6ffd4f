"""Queries over names, ids and their mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom import dims
from maskloom.functions import bones as B
from maskloom.functions.bone_tables import MATERIAL_RULES
from maskloom.functions import names as N
from maskloom.plans.catalog import query
from maskloom.plans.tables import VIEW_ANGLES

_ANG = "|".join(sorted(VIEW_ANGLES.split(",")[:-1], key=lambda a: (-len(a), a)))
_STY = "|".join(dims.longest_first(dims.STYLES))


@query(rf"""
WITH m AS (SELECT doc_id, stem, '^(.+)_pose_(\d{{2}})(.*?)(?:_({_ANG}))?_({_STY})$' AS p FROM v_assets)
SELECT doc_id, stem, nullif(regexp_extract(stem, p, 1), '') AS p_char, nullif(regexp_extract(stem, p, 2), '') AS p_pose,
  CASE WHEN regexp_matches(stem, p) THEN coalesce(nullif(regexp_extract(stem, p, 4), ''), CASE WHEN regexp_extract(stem, p, 3) = '' THEN 'front' END) END AS p_angle, nullif(regexp_extract(stem, p, 5), '') AS p_style FROM m""")
def parse_stem(t):
    return t.v_assets.select("doc_id", "stem").withColumns(N.parse_stem("stem"))


@query(rf"""
WITH m AS (SELECT stem, '^(.+)_pose_(\d{{2}})(.*?)(?:_({_ANG}))?_({_STY})$' AS p FROM v_assets)
SELECT regexp_extract(stem, p, 3)[2:] AS name, count(*) AS n FROM m WHERE regexp_matches(stem, p) AND regexp_extract(stem, p, 4) = '' AND regexp_extract(stem, p, 3) <> '' GROUP BY 1""")
def unknown_angles(t):
    """Report of names in the place of an angle that the list does not have."""
    return t.v_assets.select(N.unknown_angle("stem").alias("name")).where("name IS NOT NULL").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


_IDS = """
SELECT doc_id, CASE mod(doc_id, 6) WHEN 0 THEN stem WHEN 1 THEN concat('humanrig_', CAST(doc_id AS STRING), '_t_pose_01_front')
  WHEN 2 THEN concat('fbanimehq_', CAST(n AS STRING), '_', CAST(doc_id AS STRING)) WHEN 3 THEN concat('stdgen_', CAST(n AS STRING), '_front')
  WHEN 4 THEN concat('animerun_clip', CAST(n AS STRING), '_', CAST(doc_id AS STRING)) ELSE concat('plain-', CAST(doc_id AS STRING)) END AS example
FROM v_assets"""


@query(rf"""
WITH i AS ({_IDS})
SELECT doc_id, example, coalesce({", ".join(f"nullif(regexp_extract(example, '{p}', 1), '')" for p in N.CHARACTER_PATTERNS)}, example) AS char_id FROM i""")
def character_id(t):
    return t.sql(_IDS).withColumn("char_id", N.character_id(F.col("example")))


@query("""
SELECT char_id, CASE WHEN lower(char_id) LIKE 'mixamo%' THEN 'mixamo' WHEN lower(char_id) LIKE 'quaternius%' THEN 'quaternius'
 WHEN lower(char_id) LIKE 'kenney%' THEN 'kenney' WHEN lower(char_id) LIKE 'sketchfab%' THEN 'sketchfab' ELSE 'unknown' END AS source,
 CASE WHEN char_id LIKE 'mixamo\\_%' ESCAPE '\\' THEN 'mixamo' WHEN char_id LIKE 'ken\\_%' ESCAPE '\\' THEN 'ken' ELSE batch END AS strict_source, count(*) AS n
FROM v_assets GROUP BY ALL""")
def infer_source(t):
    c = F.col("char_id")
    rows = t.v_assets.select(
        "char_id", N.infer_source(c).alias("source"),
        N.infer_source(c, ["mixamo", "ken"], F.col("batch"), strict_underscore=True, fold_case=False).alias("strict_source"),
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


_ASSET_IDS = """
SELECT doc_id, concat(CASE mod(doc_id, 5) WHEN 0 THEN 'ChatGPT Image ' WHEN 1 THEN 'sora_' WHEN 2 THEN 'pixabay_' WHEN 3 THEN 'Gemini_Generated_Image_' ELSE '' END,
  lang, ' - ', source, ', ', CAST(n_chars AS STRING), '__x_') AS stem FROM documents"""


@query(f"""
WITH s AS ({_ASSET_IDS}), v AS (SELECT doc_id, stem, CASE WHEN lower(stem) LIKE 'chatgpt%' THEN 'chatgpt' WHEN lower(stem) LIKE 'sora%' THEN 'sora'
  WHEN lower(stem) LIKE 'pixabay%' THEN 'pixabay' ELSE 'gemini' END AS vendor FROM s),
b AS (SELECT *, CASE vendor WHEN 'chatgpt' THEN regexp_replace(lower(stem), '^chatgpt image ', '') WHEN 'sora' THEN regexp_replace(stem, '^sora_', '')
  WHEN 'pixabay' THEN regexp_replace(stem, '^pixabay_', '') ELSE regexp_replace(stem, '^Gemini_Generated_Image_', '') END AS rest FROM v)
SELECT doc_id, vendor, concat(vendor, '_', trim(regexp_replace(regexp_replace(replace(rest, ',', ''), '[ -]', '_', 'g'), '_+', '_', 'g'), '_')) AS asset_id FROM b""")
def clean_asset_id(t):
    stem = F.col("stem")
    return t.sql(_ASSET_IDS).select("doc_id", N.vendor_of(stem).alias("vendor"), N.clean_asset_id(stem).alias("asset_id"))


@query(rf"""
WITH s AS (SELECT doc_id, CASE WHEN mod(doc_id, 4) = 0 THEN concat(view_key, '_high_back') ELSE stem END AS stem FROM v_assets)
SELECT doc_id, coalesce(nullif(regexp_extract(stem, '_({_ANG})(?:_|$)', 1), ''), 'front') AS found_angle FROM s""")
def detect_angle(t):
    stem = F.when(F.col("doc_id") % 4 == 0, F.concat("view_key", F.lit("_high_back"))).otherwise(F.col("stem"))
    return t.v_assets.select("doc_id", N.detect_angle(stem).alias("found_angle"))


_PREFIX = N.prefix_pattern()
_TOKENS = rf"""
tok AS (SELECT k, rig, name, list_transform(list_filter(string_split_regex(lower(regexp_replace(regexp_replace(regexp_replace(name, '(?i){_PREFIX}', ''),
   '[._]\d+$', ''), '([a-z])([A-Z])', '\1_\2', 'g')), '[_.\-\s]+'), lambda x: x <> ''),
   lambda x: CASE x WHEN 'l' THEN 'left' WHEN 'r' THEN 'right' ELSE x END) AS tokens FROM v_names)"""


@query(f"WITH {_TOKENS} SELECT k, name, array_to_string(tokens, '|') AS tokens FROM tok")
def tokenize_name(t):
    return t.v_names.select("k", "name", F.array_join(N.tokenize_name(F.col("name")), "|").alias("tokens"))


_RULES = [*MATERIAL_RULES, (r"\bred\b", "accessory")]


@query(f"""SELECT k, name, CASE {" ".join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{r}'" for p, r in _RULES)} ELSE 'UNMAPPED' END AS region,
 CASE WHEN {" OR ".join(f"regexp_matches(name, '(?i){p}')" for p, r in _RULES)} THEN 'auto' ELSE 'pending' END AS confirmed FROM v_names""")
def map_name_ordered(t):
    region = N.first_rule(F.col("name"), _RULES)
    out = t.v_names.select("k", "name", region.alias("region"))
    return out.withColumn("confirmed", F.when(F.col("region") == "UNMAPPED", "pending").otherwise("auto"))


def _words(w):
    return "[" + ", ".join(f"'{x}'" for x in w) + "]"


def _sql_lookup(rows):
    return ", ".join(f"('{n}', {r}, '{m}')" for n, r, m in rows)


_OVERRIDES = """
SELECT p_brand AS rig, concat('{{"', min(p_name), '": "', CAST(mod(min(p_partkey), 23) AS STRING), '", "', max(p_name), '": ', CASE WHEN min(p_size) = 1 THEN 'null' ELSE '"7"' END, ', "tail bone": "x"}}') AS doc
FROM part GROUP BY p_brand""".replace("{{", "{").replace("}}", "}")

_OVERRIDE_SQL = f"""
ov_doc AS ({_OVERRIDES}),
ov AS (SELECT rig, unnest(json_keys(doc)) AS name, doc FROM ov_doc),
ovr AS (SELECT rig, name, TRY_CAST(json_extract_string(doc, '$."' || name || '"') AS INT) AS region FROM ov)"""


@query(f"WITH {_OVERRIDE_SQL} SELECT rig, name, region FROM ovr WHERE region BETWEEN 1 AND 19")
def load_overrides(t):
    return B.load_overrides(t.sql(_OVERRIDES))


_CASCADE = f"""
WITH {_TOKENS}, {_OVERRIDE_SQL},
look(name, region, method) AS (VALUES {_sql_lookup(B.lookup_rows())}),
ali(name, region) AS (VALUES {", ".join(f"('{n}', {r})" for n, r in B.ALIASES.items())}),
kw(i, words, region) AS (VALUES {", ".join(f"({i}, {_words(w)}, {r})" for i, (w, r) in enumerate(B.KEYWORD_RULES))}),
fz(i, words, region) AS (VALUES {", ".join(f"({i}, {_words(w)}, {r})" for i, (w, r) in enumerate(B.FUZZY_RULES))}),
u AS (SELECT DISTINCT name, tokens, string_split_regex(lower(name), '[_.\\-\\s]+') AS raw, regexp_replace(name, '{_PREFIX}', '') AS bare FROM tok),
k AS (SELECT u.name, arg_min(kw.region, kw.i) AS region FROM u JOIN kw ON list_bool_and(list_transform(kw.words,
   lambda w: CASE WHEN w IN ('l', 'r') THEN list_contains(u.raw, w) ELSE contains(lower(u.name), w) END)) GROUP BY 1),
fs AS (SELECT u.name, fz.region, fz.i, len(fz.words) AS w, len(list_intersect(fz.words, u.tokens)) / len(fz.words) AS score FROM u JOIN fz ON TRUE),
f AS (SELECT name, region, score FROM fs WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, w DESC, i) = 1),
res AS (SELECT n.k, n.rig, n.name,
  coalesce(o.region, l.region, CASE WHEN u.bare <> u.name THEN a.region END, k.region, f.region) AS region,
  CASE WHEN o.region IS NOT NULL THEN 'override' WHEN l.region IS NOT NULL THEN l.method WHEN u.bare <> u.name AND a.region IS NOT NULL THEN 'prefix'
    WHEN k.region IS NOT NULL THEN 'substring' WHEN f.region IS NOT NULL THEN 'fuzzy' ELSE 'unmapped' END AS method, f.score
 FROM v_names n JOIN u ON u.name = n.name
 LEFT JOIN (SELECT * FROM ovr WHERE region BETWEEN 1 AND 19) o ON o.rig = n.rig AND o.name = n.name
 LEFT JOIN look l ON l.name = n.name LEFT JOIN ali a ON a.name = u.bare LEFT JOIN k ON k.name = n.name LEFT JOIN f ON f.name = n.name)
"""


def _mapped(t):
    return B.map_bones(t.v_names, B.load_overrides(t.sql(_OVERRIDES)))


@query(_CASCADE + "SELECT k, rig, name, CAST(region AS INT) AS region, method, round(CASE WHEN method = 'fuzzy' THEN score END, 6) AS score FROM res")
def map_name_cascade(t):
    return _mapped(t).select("k", "rig", "name", "region", "method", F.round("score", 6).alias("score"))


@query(_CASCADE + """SELECT rig, count(region) AS mapped, count(*) - count(region) AS unmapped, count(*) AS total,
 round_even(count(region) / count(*), 4) AS auto_rate, CASE WHEN count(region) / count(*) >= 0.8 THEN 'good' ELSE 'poor' END AS verdict,
 CAST(sum(CAST(method = 'override' AS INT)) AS BIGINT) AS n_override, CAST(sum(CAST(method = 'exact' AS INT)) AS BIGINT) AS n_exact,
 CAST(sum(CAST(method = 'alias' AS INT)) AS BIGINT) AS n_alias, CAST(sum(CAST(method = 'prefix' AS INT)) AS BIGINT) AS n_prefix,
 CAST(sum(CAST(method = 'substring' AS INT)) AS BIGINT) AS n_substring, CAST(sum(CAST(method = 'fuzzy' AS INT)) AS BIGINT) AS n_fuzzy FROM res GROUP BY 1""")
def mapping_summary(t):
    rate = F.count("region") / F.count(F.lit(1))
    methods = ["override", "exact", "alias", "prefix", "substring", "fuzzy"]
    return _mapped(t).groupBy("rig").agg(
        F.count("region").alias("mapped"), (F.count(F.lit(1)) - F.count("region")).alias("unmapped"), F.count(F.lit(1)).alias("total"),
        F.bround(rate, 4).alias("auto_rate"), F.when(rate >= 0.8, "good").otherwise("poor").alias("verdict"),
        *[F.count_if(F.col("method") == m).alias(f"n_{m}") for m in methods],
    )


@query(_CASCADE + "SELECT CAST(region AS INT) AS region, name, count(*) AS n FROM res GROUP BY ALL")
def names_per_region(t):
    return _mapped(t).groupBy("region", "name").agg(F.count(F.lit(1)).alias("n"))


@query(_CASCADE + """SELECT DISTINCT rig, name FROM res WHERE region IS NULL AND rig NOT IN (SELECT rig FROM ovr WHERE region = 7)""")
def override_template(t):
    """Unmapped names of the rigs without an override row; sorted when written."""
    done = B.load_overrides(t.sql(_OVERRIDES)).where("region = 7").select("rig")
    return _mapped(t).where("region IS NULL").select("rig", "name").distinct().join(done, "rig", "left_anti")


@query("""SELECT example_id, class_id, CASE WHEN class_name LIKE '%\\_l' ESCAPE '\\' AND cx > 0 THEN regexp_replace(class_name, '_l$', '_r')
 WHEN class_name LIKE '%\\_r' ESCAPE '\\' AND cx < 0 THEN regexp_replace(class_name, '_r$', '_l') ELSE class_name END AS region
FROM (SELECT v.example_id, v.class_id, c.class_name, CAST(sum(v.len * (2 * v.x0 + v.len - 1) - v.len * 63) AS BIGINT) AS cx FROM v_runs v JOIN v_classes c ON c.class_id = v.class_id GROUP BY ALL)""")
def disambiguate_side(t):
    from maskloom.operators.masks import class_names_for

    x = t.v_runs.groupBy("example_id", "class_id").agg(F.sum(F.expr("len * (2 * x0 + len - 1) - len * 63")).alias("cx"))
    return class_names_for(x).select("example_id", "class_id", N.disambiguate_side(F.col("class_name"), F.col("cx")).alias("region"))
