"""One query per operator, with check SQL where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskloom.llm import ann, byte_bpe, chat, language_id, license_scan, merkle, mixing, ngram_join, prefix_trie, quality_classifier, quality_rules, token_counts, warc
from maskloom.session import cut, ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_source_mixing(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"),
        F.col("mix_copies").alias("whole_copies"), F.col("mix_fraction").alias("fraction_words"),
    )


SQL["op5_source_mixing"] = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents),
s AS MATERIALIZED (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
levels AS (
  SELECT 3.0::DOUBLE * source_size / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS MATERIALIZED (
  SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio LIMIT 1)) AS target FROM s),
g AS (SELECT *, floor(target + 0.5)::BIGINT AS goal, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS copies FROM t),
r AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.copies, g.goal - g.copies * g.source_size AS extra,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
m AS (SELECT *, greatest(0, least(size, extra - (upto - size)))::BIGINT AS more FROM r)
SELECT doc_id, size, source_size, target, (copies * size + more)::BIGINT AS taken,
       CASE WHEN size = 0 THEN 0 ELSE copies + (more = size)::BIGINT END::BIGINT AS whole_copies, CASE WHEN more < size THEN more ELSE 0 END::BIGINT AS fraction_words
FROM m
"""


def bpe_digests(rows: DataFrame, *kept: str) -> DataFrame:
    return rows.select(
        *kept, F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), "doc_id")


@query
def op6_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


SQL["op6_quality_rules"] = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS MATERIALIZED (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM (
  SELECT rid, pos, word AS a, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)) WHERE c IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT pos + k)::BIGINT AS n_repeat_words FROM g, unnest([0, 1, 2]) AS t(k) WHERE n > 1 GROUP BY rid),
m AS MATERIALIZED (
  SELECT d.rid, doc_id, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d) AS d LEFT JOIN rep USING (rid)),
b AS MATERIALIZED (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS MATERIALIZED (
  SELECT rid, doc_id, lang, base_failed, 'symbols' AS rule, 1 AS nr, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS val FROM b
  UNION ALL SELECT rid, doc_id, lang, base_failed, 'repeats', 2, CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END FROM b
  UNION ALL SELECT rid, doc_id, lang, base_failed, 'dup_lines', 3, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END FROM b
  UNION ALL SELECT rid, doc_id, lang, base_failed, 'upper', 4, CASE WHEN n_letters > 0 THEN n_upper / n_letters ELSE 0 END FROM b),
c AS (SELECT unnest([0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02])::DOUBLE AS cutoff),
l AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (SELECT v.*, good FROM v JOIN l USING (doc_id) WHERE NOT base_failed),
n AS (SELECT lang, rule, cutoff, count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 1 AND val > cutoff) AS x, count(*) FILTER (good = 0 AND val > cutoff) AS y
      FROM h, c GROUP BY ALL),
p AS (SELECT *, n = 0 OR x > 0.005 * n OR (SELECT sum(exp(lgamma(n.n + 1) - lgamma(i + 1) - lgamma(n.n - i + 1) + i * ln(0.005) + (n.n - i) * ln(0.995)))
                     FROM range(0, x + 1) AS r(i)) > 0.05 / (4 * (SELECT count(DISTINCT coalesce(lang, '')) FROM h)) AS fails FROM n),
q AS (SELECT *, bool_or(fails) OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS stopped FROM p),
u AS (SELECT lang, rule, arg_max(cutoff, (y, cutoff)) AS cutoff FROM q WHERE NOT stopped AND y > 0 GROUP BY lang, rule),
r AS (SELECT rid, string_agg(v.rule, ',' ORDER BY nr) AS hits FROM v JOIN u ON v.rule = u.rule AND v.lang IS NOT DISTINCT FROM u.lang WHERE val > cutoff GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND hits IS NULL AS kept,
       concat_ws(',', CASE WHEN base_failed THEN 'base' END, hits) AS rejected_by
FROM b LEFT JOIN r USING (rid)
"""


@query
def op7_license_scan(spark, sf_dir):
    found = license_scan.label_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', '{t}')" for i, (label, t) in enumerate(license_scan.TEMPLATES))
_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL["op7_license_scan"] = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce({_WORDS.format("text")}, []) AS ws FROM documents),
w AS MATERIALIZED (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
p AS (SELECT rid, pos, CASE WHEN word = 'cc' AND b = 'by' THEN 'cc-by' WHEN word = 'general' AND b = 'public' AND c = 'license' THEN 'gpl'
             WHEN word = 'all' AND b = 'rights' AND c = 'reserved' THEN 'reserved' END AS label
      FROM (SELECT *, lead(word) OVER o AS b, lead(word, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos))),
base AS (SELECT rid, count(*)::BIGINT AS n_base, min(pos)::BIGINT AS first_word, max(pos)::BIGINT AS last_word, list(DISTINCT label) AS found FROM p WHERE label IS NOT NULL GROUP BY rid),
t AS (SELECT template, label, unnest(list_distinct(ws)) AS word, len(list_distinct(ws)) AS size
      FROM (SELECT template, label, {_WORDS.format("body")} AS ws FROM (VALUES {_TEMPLATE_ROWS}) AS v(template, label, body))),
b AS (SELECT doc_id, rid, word, unnest([pos // {license_scan.STEP}, pos // {license_scan.STEP} - 1]) AS block, greatest(0, ceil((n - {license_scan.BLOCK}) / {license_scan.STEP})) AS last FROM w),
m AS (SELECT doc_id, rid, block, label, size, count(DISTINCT b.word) AS overlap FROM b JOIN t USING (word) WHERE block BETWEEN 0 AND last
      GROUP BY doc_id, rid, block, template, label, size HAVING count(DISTINCT b.word) >= {license_scan.CONTAINMENT} * size),
f AS (SELECT doc_id, list(DISTINCT label) AS more, max(overlap / size) AS best FROM m GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, array_to_string(list_sort(coalesce(found, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(found, []) || coalesce(more, []))), ',') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN f ON f.doc_id IS NOT DISTINCT FROM d.doc_id
"""


def shared_folder(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query
def op1_token_counts(spark, sf_dir):
    """All documents are inserted, toxic ones deleted, those labelled bad recounted without symbol-only words, then a version is added; the deletes come twice."""
    store = token_counts.Rollup(spark, shared_folder(spark, "token-counts"))
    text = F.regexp_replace("text", r"(?<![^\x20\x09-\x0D])[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])", "")
    docs = cut(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", token_counts.count(F.col("text"), "words-1").alias("words"), token_counts.count(text, "words-1").alias("clean"),
        token_counts.count(F.col("text"), "runs-2").alias("runs")))
    labels = table(spark, sf_dir, "labels")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    bad = labels.where("quality = 0").select("doc_id").distinct()
    left = docs.join(toxic, "doc_id", "left_anti")
    deletes = token_counts.events(docs.join(toxic, "doc_id", "left_semi"), "delete", "words-1", before=F.col("words"))
    store.commit("insert-1", token_counts.events(docs, "insert", "words-1", after=F.col("words")))
    store.commit("delete-1", deletes)
    store.commit("revise-1", token_counts.events(left.join(bad, "doc_id", "left_semi"), "revise", "words-1", before=F.col("words"), after=F.col("clean")))
    store.compact()
    store.commit("insert-2", token_counts.events(left, "insert", "runs-2", after=F.col("runs")))
    store.commit("delete-1", deletes)
    return store.totals()


SQL["op1_token_counts"] = r"""
WITH d AS MATERIALIZED (
  SELECT source, lang, len(ws)::BIGINT AS words, len(list_filter(ws, lambda x: regexp_matches(x, '[A-Za-z0-9\x{80}-\x{10FFFF}]')))::BIGINT AS clean,
         coalesce(len(regexp_extract_all(text, '[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]+|[^A-Za-z0-9\x{80}-\x{10FFFF}\x20\x09-\x0D]+')), 0)::BIGINT AS runs,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 0), false) AS bad
  FROM (SELECT *, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents)),
e AS (
  SELECT source, lang, 'words-1' AS tokenizer_version, 1 AS n_docs, words AS n_tokens FROM d
  UNION ALL SELECT source, lang, 'words-1', -1, -words FROM d WHERE toxic
  UNION ALL SELECT source, lang, 'words-1', 0, clean - words FROM d WHERE bad AND NOT toxic
  UNION ALL SELECT source, lang, 'runs-2', 1, runs FROM d WHERE NOT toxic)
SELECT source, lang, tokenizer_version, sum(n_docs)::BIGINT AS n_docs, sum(n_tokens)::BIGINT AS n_tokens FROM e GROUP BY ALL
"""


@query
def op10_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "score", "kept")


@query
def op8_language_id(spark, sf_dir):
    docs, path = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    names, model = language_id.learn(docs, path)
    return language_id.identify(docs.select("doc_id", "text"), names, model, path).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_ngram_join(spark, sf_dir):
    return ngram_join.components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_chat_tree(spark, sf_dir):
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    place = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    read = chat.read_back(chat.pack(rows, *place), *place)
    said_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said_turns, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


SQL["op4_chat_tree"] = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')) AS v),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
             + length('<|im_start|>' || '<|im_end|>') + 2 AS chars FROM t),
g AS (SELECT conv_id, count(*)::BIGINT AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned, sum(chars)::BIGINT AS formatted_chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned)::BIGINT AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""


@query
def op3_hnsw_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 100 == 0)


@query
def op11_warc_archive(spark, sf_dir):
    folder = shared_folder(spark, "warc")
    warc.write(warc.mark(table(spark, sf_dir, "pages").select("page_id", "url", "html")), folder, batch="pages")
    found = warc.read(spark, folder, [("record_type", "in", ["response", "revisit"])], payload="check")
    whole = F.when(F.coalesce("intact", F.lit(True)), F.col("payload_digest"))
    return found.select("page_id", "payload_bytes", whole.alias("payload_digest"), "record_type", "refers_to")


SQL["op11_warc_archive"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM (SELECT *, payload_bytes >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top AS again FROM t)
"""


#: CRC-32 of a text of ASCII characters, bit by bit
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1), lambda i: [ascii({0}[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)), 4294967295::BIGINT)"
)


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(struck, merkle.leaf([*fields[:-1], F.translate("text", upper, lower)]))
    rows = merkle.manifest(docs, "source", "doc_id", fields, changed)
    folded = rows.withColumn("folded_root", merkle.fold(F.coalesce("changed", "leaf"), F.col("path")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


SQL["op12_merkle_manifest"] = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, *, coalesce('+' || source, '') AS g,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
l AS MATERIALIZED (
  SELECT rid, doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS changed,
    {_CRC.format("(doc_id::VARCHAR)")} AS struck FROM d),
i AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM l),
lv AS (
  SELECT g, 0 AS level, idx, leaf AS h, n FROM i
  UNION ALL
  SELECT g, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM lv WHERE n > 1 GROUP BY g, level, idx // 16, n),
sub AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1),
tv AS (
  SELECT 0 AS level, idx, subroot AS h, n FROM sub
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM tv WHERE n > 1 GROUP BY level, idx // 16, n),
up AS MATERIALIZED (SELECT g, level, idx, h, n FROM lv WHERE n > 1),
low AS (
  SELECT i.rid, a.level AS nr, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS before, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS after
  FROM i JOIN up AS a ON a.g = i.g AND a.idx = i.idx // (16 ** a.level)::BIGINT JOIN up AS b ON b.g = a.g AND b.level = a.level AND b.idx // 16 = a.idx // 16
  GROUP BY i.rid, a.level),
high AS (
  SELECT s.g, 1000 + a.level AS nr, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx) AS before, string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx) AS after
  FROM sub AS s JOIN tv AS a ON a.n > 1 AND a.idx = s.idx // (16 ** a.level)::BIGINT JOIN tv AS b ON b.level = a.level AND b.idx // 16 = a.idx // 16
  GROUP BY s.g, a.level),
st AS MATERIALIZED (
  SELECT rid, coalesce(before, '') AS before, coalesce(after, '') AS after, row_number() OVER (PARTITION BY rid ORDER BY nr) AS nr
  FROM (SELECT * FROM low UNION ALL SELECT i.rid, high.nr, before, after FROM i JOIN high ON high.g = i.g)),
f AS (
  SELECT rid, 0::BIGINT AS nr, CASE WHEN doc_id IS NOT NULL AND struck % 5 = 0 THEN changed ELSE leaf END AS h FROM i
  UNION ALL
  SELECT f.rid, f.nr + 1, sha256(before || h || after) FROM f JOIN st ON st.rid = f.rid AND st.nr = f.nr + 1),
p AS (SELECT rid, max(nr) AS steps, sha256(string_agg(before || after, '' ORDER BY nr)) AS proof_sha256 FROM st GROUP BY rid),
r AS (SELECT h AS root FROM tv WHERE n = 1)
SELECT i.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM i JOIN sub USING (g) CROSS JOIN r LEFT JOIN p ON p.rid = i.rid JOIN f ON f.rid = i.rid AND f.nr = coalesce(p.steps, 0)
"""


@query
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


SQL["op13_prefix_trie"] = rf"""
WITH t AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), left(coalesce(text, ''), {prefix_trie.TIE}), sha256(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC.format("(conv_id::VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (
  SELECT c.conv_id, 0 AS part, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
s AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, length(text) AS chars, sha256(length(role) || ':' || role || text) AS name FROM b),
p AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS chars FROM c
  UNION ALL SELECT conv_id, depth, string_agg(name, '') OVER o, coalesce(string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), chars
  FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS MATERIALIZED (SELECT conv_id, depth, sha256(node) AS node, sha256(parent) AS parent, chars, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS MATERIALIZED (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS said FROM q GROUP BY depth, node),
k AS MATERIALIZED (SELECT n.*, (SELECT count(*) FROM n AS m WHERE m.parent = n.node) AS n_children FROM n),
u AS (SELECT a.node, sum((k.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(k.saved)::BIGINT AS saved_tokens
      FROM k JOIN q AS a ON a.conv_id = k.conv_id AND a.depth <= k.depth GROUP BY a.node)
SELECT k.conv_id, k.depth, m.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves, saved_tokens, sha256(k.said) AS ends_sha256
FROM k JOIN u USING (node) LEFT JOIN n AS m ON m.node = k.parent
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
