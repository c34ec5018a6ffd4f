"""Queries that merge, split and update the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskloom.functions import names as N
from maskloom.operators import merge as G
from maskloom.operators import splits as S
from maskloom.plans.catalog import query

_MERGE = """
WITH r AS (SELECT *, CASE WHEN NOT has_files THEN 'no_files' WHEN width <> 512 THEN 'bad_resolution' END AS reject FROM v_chars),
g AS (SELECT char_id, source, min(source_rank) AS first_rank FROM r WHERE reject IS NULL GROUP BY ALL),
o AS (SELECT *, first_value(source) OVER (PARTITION BY char_id ORDER BY first_rank, source) AS owner FROM g),
n AS (SELECT *, CASE WHEN source = owner THEN char_id ELSE source || '_' || char_id END AS wish FROM o),
k AS (SELECT *, row_number() OVER (PARTITION BY wish ORDER BY CAST(wish <> char_id AS INT), first_rank, char_id) AS kk FROM n),
m AS (SELECT r.char_id, r.source, r.source_rank, CASE WHEN reject IS NOT NULL THEN reject WHEN source_rank <> first_rank THEN 'duplicate'
   WHEN wish <> r.char_id OR kk > 1 THEN 'renamed' ELSE 'kept' END AS status, CASE WHEN kk = 1 THEN wish ELSE wish || '_' || kk END AS target
 FROM r LEFT JOIN k ON k.char_id = r.char_id AND k.source = r.source)
"""


def _merged(t):
    valid = F.when(~F.col("has_files"), "no_files").when(F.col("width") != 512, "bad_resolution")
    return G.merge_characters(t.v_chars, valid)


@query(_MERGE + "SELECT char_id, source, source_rank, status, CASE WHEN status IN ('kept', 'renamed') THEN target END AS merged_id FROM m")
def merge_datasets(t):
    return _merged(t)


@query(_MERGE + "SELECT status, count(*) AS n FROM m GROUP BY 1")
def merge_report(t):
    return G.merge_report(_merged(t))


@query("""
WITH g AS (SELECT char_id, source, min(source_rank) AS f FROM v_chars GROUP BY ALL),
o AS (SELECT *, first_value(source) OVER (PARTITION BY char_id ORDER BY f, source) AS owner FROM g)
SELECT char_id, source, CASE WHEN source = owner THEN char_id ELSE source || '_' || char_id END AS merged_id FROM o""")
def disambiguate_ids(t):
    out = G.merge_characters(t.v_chars).where("status IN ('kept', 'renamed')")
    return out.select("char_id", "source", "merged_id")


_OLD = "SELECT CAST(c_custkey AS STRING) AS char_id, lower(c_mktsegment) AS source, c_acctbal AS height FROM customer WHERE c_nationkey < 18"
_NEW = "SELECT CAST(s_suppkey AS STRING) AS char_id, 'supplier' AS source, s_acctbal AS height FROM supplier UNION ALL SELECT CAST(c_custkey + 700 AS STRING), 'late', c_acctbal FROM customer WHERE c_custkey > 300"


@query(f"""
WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(n.char_id, o.char_id) AS char_id, coalesce(n.source, o.source) AS source, coalesce(n.height, o.height) AS height,
 CASE WHEN o.char_id IS NULL THEN 'new' WHEN n.char_id IS NULL THEN 'kept' ELSE 'updated' END AS change FROM o FULL JOIN n ON n.char_id = o.char_id""")
def upsert_profiles(t):
    return G.upsert(t.sql(_OLD), t.sql(_NEW), "char_id")


_HITS = """SELECT directory AS repo, 1 AS rank, concat(directory, '/') AS html_url, size FROM v_pages WHERE size > 2000
UNION ALL SELECT directory, 2, concat(directory, '#2'), size FROM v_pages"""


@query(f"""
WITH h AS ({_HITS}) SELECT repo, rank, html_url, size, hits FROM (SELECT *, count(*) OVER (PARTITION BY repo) AS hits,
  row_number() OVER (PARTITION BY repo ORDER BY rank, html_url, size) AS rn FROM h) WHERE rn = 1""")
def first_seen_union(t):
    return G.first_seen(t.sql(_HITS), "repo", "rank")


@query("""
WITH new AS (SELECT char_id, source FROM v_chars WHERE source_rank = 3),
u AS (SELECT coalesce(max(TRY_CAST(regexp_extract('live2d_' || char_id, '^live2d_(\\d+)$', 1) AS BIGINT)), 0) AS top FROM v_chars WHERE source = 'supplier')
SELECT new.char_id, new.source, top + row_number() OVER (ORDER BY source, new.char_id) AS number,
  printf('live2d_%03d', top + row_number() OVER (ORDER BY source, new.char_id)) AS model_id FROM new, u""")
def next_surrogate_id(t):
    chars = t.v_chars
    old = chars.where("source = 'supplier'").select(F.concat(F.lit("live2d_"), "char_id").alias("model_id"))
    new = chars.where("source_rank = 3").select("char_id", "source")
    return G.next_surrogate_ids(old, new, "model_id", "live2d", ["source", "char_id"])


@query("""
SELECT directory, file, min(page_id) AS page_id FROM v_pages n WHERE NOT EXISTS
 (SELECT 1 FROM v_pages e WHERE e.size > 6000 AND e.directory = n.directory AND e.file = n.file) GROUP BY 1, 2""")
def insert_or_ignore(t):
    pages = t.v_pages.select("directory", "file", "page_id", "size")
    return G.insert_or_ignore(pages.where("size > 6000"), pages.drop("size"), ["directory", "file"])


# --- splits ---
_STRAT = """
WITH c AS (SELECT DISTINCT char_id, source FROM v_chars),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || char_id), char_id) AS rank, count(*) OVER (PARTITION BY source) AS n FROM c),
s AS (SELECT char_id, source, CASE WHEN rank <= round_even(0.8 * n, 0) THEN 'train' WHEN rank <= round_even((0.8::DOUBLE + 0.1::DOUBLE) * n, 0) THEN 'val' ELSE 'test' END AS split FROM r)
"""


def _chars(t):
    return t.v_chars.select("char_id", "source").distinct()


@query(_STRAT + "SELECT * FROM s")
def stratified_split(t):
    return S.stratified_split(_chars(t))


@query(_STRAT + """, c2 AS (SELECT source, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM s GROUP BY 1)
SELECT *, round_even(100.0::DOUBLE * train / total, 1) AS train_pct, round_even(100.0::DOUBLE * val / total, 1) AS val_pct, round_even(100.0::DOUBLE * test / total, 1) AS test_pct FROM c2""")
def split_report(t):
    return S.split_report(S.stratified_split(_chars(t)))


@query(_STRAT + """SELECT char_id, min(split) AS first_split, max(split) AS last_split FROM s GROUP BY 1 HAVING min(split) <> max(split)""")
def split_leaks(t):
    """Leakage check on keys that collide across sources."""
    return S.split_leaks(S.stratified_split(_chars(t)))


_EXISTING = "SELECT char_id, CASE WHEN source_rank = 2 THEN 'test' WHEN mod(length(char_id), 3) = 0 THEN 'val' ELSE 'train' END AS split FROM v_chars WHERE source = 'supplier' UNION ALL SELECT concat('old_', char_id), 'val' FROM v_chars WHERE source = 'furniture' AND source_rank = 1"


@query(f"""
WITH e AS ({_EXISTING}), new AS (SELECT DISTINCT char_id FROM v_chars WHERE char_id NOT IN (SELECT char_id FROM e)),
c AS (SELECT count(*) FILTER (split = 'train') AS a, count(*) FILTER (split = 'val') AS b, count(*) FILTER (split = 'test') AS c, (SELECT count(*) FROM new) AS m FROM e),
d AS (SELECT m, [0.8::DOUBLE * (a + b + c + m) - a, 0.1::DOUBLE * (a + b + c + m) - b, 0.1::DOUBLE * (a + b + c + m) - c] AS d FROM c),
s AS (SELECT m, d, list_reverse_sort(d) AS z FROM d),
l AS (SELECT d, CASE WHEN z[3] >= (z[1] + z[2] + z[3] - m) / 3 THEN (z[1] + z[2] + z[3] - m) / 3 WHEN z[2] >= (z[1] + z[2] - m) / 2 THEN (z[1] + z[2] - m) / 2 ELSE z[1] - m END AS lv FROM s),
q AS (SELECT round_even(greatest(d[1] - lv, 0), 0) AS c1, round_even(greatest(d[1] - lv, 0) + greatest(d[2] - lv, 0), 0) AS c2 FROM l),
r AS (SELECT char_id, row_number() OVER (ORDER BY md5('42:' || char_id), char_id) AS rank FROM new)
SELECT char_id, split, FALSE AS is_new FROM e UNION ALL
SELECT char_id, CASE WHEN rank <= c1 THEN 'train' WHEN rank <= c2 THEN 'val' ELSE 'test' END, TRUE FROM r, q""")
def incremental_split(t):
    return S.incremental_split(_chars(t), t.sql(_EXISTING))


@query(f"""
WITH e AS ({_EXISTING}), c AS (SELECT DISTINCT char_id, source FROM v_chars)
SELECT c.char_id, source, CASE WHEN source = 'machinery' THEN 'train' ELSE coalesce(CASE WHEN split <> 'train' THEN split END, 'train') END AS split
FROM c LEFT JOIN e ON e.char_id = c.char_id""")
def frozen_split(t):
    return S.frozen_split(_chars(t), t.sql(_EXISTING), ["machinery"])


_H = " + ".join(f"(('0x' || substr(md5('7:' || view_key), {1 + 8 * i}, 8))::BIGINT) % 1000 * {pow(2**32, 3 - i, 1000)}" for i in range(4))


@query(f"""WITH h AS (SELECT DISTINCT view_key, ({_H}) % 1000 AS h FROM v_assets)
SELECT view_key, CASE WHEN h < 800 THEN 'train' WHEN h < 900 THEN 'val' ELSE 'test' END AS split FROM h""")
def hash_split(t):
    return t.v_assets.select("view_key").distinct().withColumn("split", N.hash_split(F.col("view_key"), 7))


def _ratio_sql(fn):
    return f"""
WITH r AS (SELECT char_id, row_number() OVER (ORDER BY md5('42:' || char_id), char_id) AS rank, count(*) OVER () AS n FROM (SELECT DISTINCT char_id FROM v_assets))
SELECT char_id, CASE WHEN rank <= {fn('0.8::DOUBLE * n')} THEN 'train' WHEN rank <= {fn('0.8::DOUBLE * n')} + {fn('0.1::DOUBLE * n')} THEN 'val' ELSE 'test' END AS split FROM r"""


@query(_ratio_sql(lambda x: f"floor({x})"))
def shuffle_ratio_split(t):
    return S.shuffle_ratio_split(t.v_assets.select("char_id").distinct(), "char_id")


@query(_ratio_sql(lambda x: f"round_even({x}, 0)"))
def shuffle_ratio_split_rounded(t):
    return S.shuffle_ratio_split(t.v_assets.select("char_id").distinct(), "char_id", truncate=False)


_PARTS = "SELECT char_id, source_rank AS file_rank, CASE WHEN source = 'supplier' THEN 'test' WHEN width = 256 THEN 'val' ELSE 'train' END AS split FROM v_chars"


@query(f"""SELECT char_id, arg_min(split, (file_rank, split)) AS split, count(*) - 1 AS duplicates FROM ({_PARTS}) GROUP BY 1""")
def merge_splits(t):
    return S.merge_splits(t.sql(_PARTS))
