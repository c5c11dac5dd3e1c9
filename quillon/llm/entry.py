"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontaminate, html_extract, jaccard_join, language, line_dedup, packing, piece_bpe, pii, quality, spelling, token_files, url_filter
from .staging import new_path, stage, temporary

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of the url filter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("line_count").alias("n_lines"), F.col("line_drops").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The key of the surrogates. A real deployment passes a secret of its own.
PII_KEY = "quillon-surrogates"


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiled = stage(quality.profile(table(spark, sf_dir, "documents").select("doc_id", "text")), "quality")
    return quality.judge(profiled, quality.fit(profiled)).select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.learn(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), model).withColumn("held_out", held_out)


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_extract.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read(spark, path, with_ids=False)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.col("component").alias("component_id"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    with temporary(spark):
        found = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), a, b)
        digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
        aligned = stage(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
        shards = alignment.count_pairs(aligned, alignment.ids_of(a))
        out = alignment.look_up(aligned, shards)
        return stage(out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"), "alignment", keep=True)


#: Fixed value: a word loses a code point where this divides its hash.
DAMAGE = 97


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    with temporary(spark):
        words = stage(spelling.count_words(table(spark, sf_dir, "documents").select("doc_id", "text"), damage=DAMAGE), "spelling-words")
        return stage(spelling.group(words), "spelling", keep=True)


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = piece_bpe.decode(piece_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model), model)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), piece_bpe.ids_sha256(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_line_dedup, op3_pii_surrogates, op4_packing, op5_quality_rules, op6_language, op7_html_extract, op8_decontaminate, op9_token_files, op10_jaccard_join, op11_token_alignment, op12_spelling_groups, op13_sentencepiece)}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_BENCH_WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_HOST = f"translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
_PATH = "regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)"

ORACLE_SQL = {
    "op1_url_filter": f"""
WITH rules(kind, rule) AS (VALUES {", ".join(map(str, URL_RULES))}),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN {_HOST} ELSE '' END AS host, CASE WHEN strpos(url, '://') > 0 THEN {_PATH} ELSE '' END AS path FROM pages),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind FROM u, rules
        WHERE ('.' || host) LIKE ('%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN list_has_any(regexp_split_to_array(host, '[.-]'), {list(url_filter.LISTED_WORDS)}) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (page_id)""",
    "op2_line_dedup": f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM parts),
keyed AS (SELECT *, translate(trim(line, {_WHITE}), '{UPPER}', '{LOWER}') AS k FROM lines),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, i, line, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_jaccard_join": f"""
WITH RECURSIVE dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, least(len(w), 1) + 1))) AS p FROM dw WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
coded AS (SELECT doc_id, s FROM sh WHERE s IN (SELECT s FROM sh GROUP BY s HAVING count(*) > 1)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM coded a JOIN coded b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * common >= 90 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS r FROM dw UNION SELECT e.b, reach.r FROM reach JOIN edges e ON e.a = reach.a)
SELECT dw.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM dw LEFT JOIN size USING (doc_id) JOIN (SELECT a AS doc_id, min(r) AS component_id FROM reach GROUP BY a) USING (doc_id)""",
    "op8_decontaminate": f"""
WITH iw AS (SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS s
        FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM iw WHERE len(w) > 0)),
dw AS (SELECT doc_id, coalesce({_BENCH_WORDS}, []) AS w FROM documents),
placed AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
found AS (SELECT doc_id, n, p, item_id FROM placed JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT x)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS x FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*)::BIGINT AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
