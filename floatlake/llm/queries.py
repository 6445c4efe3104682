"""The operators as queries over whole tables, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floatlake.llm import clusters, decontaminate, html, language, licenses, lines, merkle, packing, private, quality, simhash, sql, substrings, urls

#: Rules of the URL query: key and verdict.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
#: Hosts with one of these between dots and hyphens are listed.
HOST_WORDS = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx"]


def tokenizer() -> tuple[str, str, str]:
    """Vocabulary, ranks and pattern of the packing query, looked up when it runs."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def __getattr__(name: str) -> tuple[str, str, str]:
    if name == "TOKENIZER":
        return tokenizer()
    raise AttributeError(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("anomaly", 6).alias("anomaly"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    found = urls.url_verdicts(pages, rules, urls.hosts_with_words(pages, HOST_WORDS))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.drop_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score",
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.main_texts(table(spark, sf_dir, "pages"))
    text = F.array_join("blocks", " ")
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(language.fold() == 1, F.lit(False))
    found = language.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), language.fold() != 1)
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang_pred"), F.round("language.score", 6).alias("score"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def pack(docs: DataFrame) -> DataFrame:
    found = packing.pack_documents(docs, *tokenizer())
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_group"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), F.when(third, merkle.lowered_text(F.col("text"))))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.centroid_clusters(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_digest(private.personal_data(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_quality_rules, op3_url_filters, op4_substring_dedup, op5_license_scans,
        op6_html_extraction, op7_language_id, op8_line_dedup, op9_packing, op10_simhash,
        op11_merkle_manifest, op12_centroid_clusters, op13_private_data,
    )
}

_SPACES = "[\\x20\\x09-\\x0D]"

_URL_SQL = f"""
WITH split_urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), rules(key, rule_host, rule_path, rule_verdict) AS (VALUES {", ".join(
    f"('{k}', '{k.split('/')[0]}', '{k[len(k.split('/')[0]):]}', '{v}')" for k, v in URL_RULES)}
), fitting AS (
  SELECT page_id, host, path, key, rule_verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC NULLS LAST, length(rule_host) DESC NULLS LAST) AS place
  FROM split_urls LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, key AS rule,
  coalesce(rule_verdict, CASE WHEN list_has_any(string_split_regex(host, '[.-]'), [{", ".join(f"'{w}'" for w in HOST_WORDS)}]) THEN 'block' ELSE 'allow' END) AS verdict
FROM fitting WHERE place = 1
"""

_LINES_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT doc_id, string_split(text, chr(10)) AS parts FROM texts),
numbered AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place FROM parts),
keys AS (
  SELECT *, translate(regexp_replace(line, '^{_SPACES}+|{_SPACES}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM numbered
), common AS (
  SELECT key, max(doc_id) AS holder FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.doc_id, k.place, k.line, coalesce(k.doc_id <> c.holder, false) AS gone FROM keys k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_WINDOWS_SQL = f"""
WITH texts AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}+'), lambda x: x <> '') AS words FROM documents),
windows AS (
  SELECT doc_id, place, md5(array_to_string(words[place:place + 49], ' ')) AS key
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS place FROM texts)
), firsts AS (SELECT key, min(doc_id) AS first FROM windows GROUP BY key HAVING min(doc_id) < max(doc_id)),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place
  FROM windows JOIN firsts USING (key) WHERE doc_id > first
), numbered AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
kept AS (
  SELECT n.doc_id, count(*) AS n_words, count(c.place) AS n_removed, string_agg(word, ' ' ORDER BY n.place) FILTER (WHERE c.place IS NULL) AS kept
  FROM numbered n LEFT JOIN covered c ON n.doc_id = c.doc_id AND n.place = c.place GROUP BY n.doc_id
)
SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(words: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words.split()) + "]"


def _phrase_sql(label: str, phrase: str) -> str:
    own = f"words[i:i + {len(phrase.split()) - 1}] = {_quoted(phrase)}"
    return f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(1, len(words) + 1), lambda i: {own})) - 1 AS pos FROM texts"


_GRAMS_SQL = "list_transform(range(1, greatest(len(words) - 1, 1)), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])"

_LICENSES_SQL = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), places AS ({" UNION ALL ".join(_phrase_sql(k, v) for k, v in licenses.BASE_PHRASES.items())}
), base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id
), templates(label, words) AS (VALUES {", ".join(f"('{k}', {_quoted(v)})" for k, v in sorted(licenses.TEMPLATES.items()))}
), text_grams AS (
  SELECT doc_id, unnest(grams) AS gram, generate_subscripts(grams, 1) - 1 AS pos FROM (SELECT doc_id, {_GRAMS_SQL} AS grams FROM texts)
), template_grams AS (
  SELECT label, size, unnest(grams) AS gram, generate_subscripts(grams, 1) - 1 AS tpos FROM (SELECT label, len(words) AS size, {_GRAMS_SQL} AS grams FROM templates)
), hits AS (SELECT doc_id, label, size, pos, tpos, pos - tpos AS diagonal FROM text_grams JOIN template_grams USING (gram)
), apart AS (
  SELECT doc_id, label, diagonal, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) > {licenses.DRIFT}, false) AS apart
  FROM (SELECT DISTINCT doc_id, label, diagonal FROM hits)
), numbered AS (
  SELECT doc_id, label, diagonal, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS number FROM apart
), covering AS (
  SELECT doc_id, label, number, size, pos, unnest(range(tpos, tpos + {licenses.GRAM})) AS word FROM hits JOIN numbered USING (doc_id, label, diagonal)
), spans AS (
  SELECT doc_id, label, CAST(count(DISTINCT word) AS DOUBLE) / size AS score FROM covering GROUP BY doc_id, label, number, size
  HAVING count(DISTINCT word) >= {licenses.COVERED} * size AND (max(pos) - min(pos) + {licenses.GRAM}) * 2 <= size * 3
), own AS (SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score FROM spans GROUP BY doc_id)
SELECT t.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(o.labels, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(o.score, 0.0) END AS score
FROM texts t LEFT JOIN base b ON t.doc_id = b.doc_id LEFT JOIN own o ON t.doc_id = o.doc_id
"""

ORACLES: dict[str, str] = {
    "op3_url_filters": _URL_SQL, "op4_substring_dedup": _WINDOWS_SQL, "op5_license_scans": _LICENSES_SQL, "op8_line_dedup": _LINES_SQL,
    "op11_merkle_manifest": sql.MANIFEST_SQL, "op12_centroid_clusters": sql.CLUSTERS_SQL,
}
