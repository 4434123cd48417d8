"""Registered queries over the shared tables, each with its DuckDB oracle.

Every query reads the parquet tables at ``sf_dir`` (through the adapters in
``sources.tables``) and runs the engine's operators on the whole tables.
The oracle SQL recomputes the same answer independently in DuckDB: its
patterns, lists and labels are written out here, not taken from the engine.
Column names and types are aligned (BIGINT counts, INT ordinals, VARCHAR text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import config
from feedlens.functions import formatting as fmt
from feedlens.functions.text import java_trim, tokens, utf16_length
from feedlens.operators import aggregate, detect, posts, stats
from feedlens.plans import quality, reports
from feedlens.plans.analysis import run_analysis
from feedlens.schemas import DICTIONARY_FILES, ENTITY_TYPES
from feedlens.sources import dictionary as dictsrc
from feedlens.sources import feeds as feedsrc
from feedlens.sources import subscriptions as subsrc
from feedlens.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ======================================================= DuckDB snippets ====

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --- Fixed values, written out by hand for the oracles. ---------------------
WS_SQL = r"'[ \t\n\x0B\f\r]+'"
TRIM_SQL = r"'^[\x00-\x20]+|[\x00-\x20]+$'"
ORACLE_TYPES = ["Person", "Organization", "University", "Place", "Technology", "ProgrammingLanguage"]
ORACLE_FILES = [
    (1, "people.txt", "Person"),
    (2, "universities.txt", "University"),
    (3, "languages.txt", "ProgrammingLanguage"),
    (4, "organizations.txt", "Organization"),
    (5, "places.txt", "Place"),
]
ORACLE_LITERALS = [
    ("Person", "The"), ("Person", "of"), ("Place", "In"), ("Place", "In"), ("Place", "New York"),
    ("University", "in"), ("ProgrammingLanguage", "en,"), ("Organization", "System"),
]
ORACLE_LINE_FILES = [("en", "people.txt"), ("de", "languages.txt"), ("fr", "places.txt"), ("es", "notas.txt")]
ORACLE_LINE_TYPES = [("en", "Person"), ("de", "ProgrammingLanguage"), ("fr", "Place"), ("es", "Persona")]
ORACLE_STATS = [
    ("feedsSuccess", "Feeds descargados exitosamente", "feeds_success"),
    ("feedsFailed", "Feeds fallidos", "feeds_failed"),
    ("postsSuccess", "Posts descargados exitosamente", "posts_success"),
    ("postsFailed", "Posts fallidos", "posts_failed"),
    ("postsFiltered", "Posts filtrados (vacíos/nulos)", "posts_filtered"),
    ("avgChars", "Largo promedio en posts", "avg_chars"),
]
MALFORMED_SQL = "'Warning: Skipping malformed subscription (missing ''name'' or ''url'' field)'"
DOWNLOAD_SQL = "'Warning: Failed to download from ''%s'' (%s)'"
PARSE_SQL = "'Warning: Failed to parse JSON from ''%s'''"
MISSING_FILE_SQL = "'Warning: Could not load dictionary file ''%s'''"
ENTITY_LINE_SQL = "'[Type=%s] %s: %d apariciones'"
TOTAL_LINE_SQL = "'Entidades totales: %d'"
TYPE_LINE_SQL = "'    [%s]: %d'"
ENTITY_HEADER_SQL = "'============ ENTIDADES NOMBRADAS MÁS FRECUENTES ============'"
TYPE_HEADER_SQL = "'============ ESTADÍSTICAS DE ENTIDADES ============'"
TYPE_SUBHEADER_SQL = "'Entidades por categoría:'"
# --- end of fixed values ------------------------------------------------------


def sql_jtrim(x: str) -> str:
    return f"regexp_replace({x}, {TRIM_SQL}, '', 'g')"


def sql_u16(x: str) -> str:
    return rf"(length({x}) + length(regexp_replace({x}, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')))"


def sql_values(rows: list[tuple]) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else _q(v)

    return ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)


LITERAL_DICT_CTE = f"dict(entity_type, entity_name) AS (VALUES {sql_values(ORACLE_LITERALS)})"
TYPE_DIM_CTE = "dim(ordinal, entity_type) AS (VALUES " + sql_values(
    [(0, "total"), *enumerate(ORACLE_TYPES, 1)]
) + ")"
FILE_MAP_CTE = "fmap(file_order, file_name, entity_type) AS (VALUES " + sql_values(ORACLE_FILES) + ")"


def sql_doc_posts(src: str = "documents") -> str:
    return f"""posts AS (
  SELECT doc_id AS post_id, source AS feed_name,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS selftext
  FROM {src})"""


SQL_PAGE_POSTS = r"""posts AS (
  SELECT page_id AS post_id, url AS feed_name,
         regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
         regexp_replace(html, '<[^>]*>', ' ', 'g') AS selftext
  FROM pages)"""

SQL_CONV_POSTS = """posts AS (
  SELECT conv_id, turn, role AS feed_name,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS selftext
  FROM conversations)"""

SQL_KEPT = "kept AS (SELECT * FROM posts WHERE title <> '' AND selftext <> '')"


def sql_words(keys: str = "post_id", fields: tuple[str, ...] = ("title", "selftext")) -> str:
    parts = " UNION ALL ".join(f"SELECT {keys}, '{f}' AS field, {f} AS text FROM kept" for f in fields)
    return f"""fields AS ({parts}),
words AS (
  SELECT {keys}, field, unnest(list_distinct(regexp_split_to_array(lower(text), {WS_SQL}))) AS word
  FROM fields)"""


def sql_hits(keys: str = "post_id") -> str:
    cols = ", ".join(f"w.{k.strip()}" for k in keys.split(","))
    return f"""hits AS (
  SELECT {cols}, w.field, d.entity_type, d.entity_name
  FROM words w JOIN dict d ON w.word = lower(d.entity_name)
  WHERE w.word <> '')"""


SQL_COUNTS = "counts AS (SELECT entity_type, entity_name, CAST(count(*) AS BIGINT) AS n FROM hits GROUP BY entity_type, entity_name)"


def sql_top(k: int) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY n DESC, entity_type, entity_name) AS BIGINT) AS rank,
       entity_type, entity_name, n
FROM counts ORDER BY n DESC, entity_type, entity_name LIMIT {k}"""


def sql_with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SQL_DOC_COUNTS = sql_with(sql_doc_posts(), SQL_KEPT, sql_words(), LITERAL_DICT_CTE, sql_hits(), SQL_COUNTS)

SQL_TWT = """twt AS (
  SELECT entity_type, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY entity_type
  UNION ALL SELECT 'total', CAST(coalesce(sum(n), 0) AS BIGINT) FROM counts)"""

SQL_TYPE_STATS = f"""{TYPE_DIM_CTE},
type_stats AS (
  SELECT d.ordinal, d.entity_type, CAST(coalesce(t.n, 0) AS BIGINT) AS n
  FROM dim d LEFT JOIN twt t ON d.entity_type = t.entity_type)"""

# Document lines (1-based line numbers), some marked by doc_id, further lines after them, and
# their dictionary-file name.
SQL_LINES = """raw_lines AS (
  SELECT doc_id, CAST(unnest(range(1, len(arr) + 1)) AS BIGINT) AS line_no, len(arr) AS n_lines, lang, unnest(arr) AS value
  FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS arr FROM documents)),
lines AS (
  SELECT doc_id, line_no, lang,
         CASE doc_id % 7 WHEN 0 THEN chr(9) || value || chr(11) WHEN 3 THEN value || chr(128512) ELSE value END AS value
  FROM raw_lines
  UNION ALL
  SELECT doc_id, CAST(n_lines + line_no AS BIGINT), lang,
         CASE doc_id % 7 WHEN 1 THEN '' WHEN 2 THEN ' # ' || value WHEN 5 THEN chr(9) || '#' || value ELSE chr(12) || chr(13) END
  FROM raw_lines WHERE doc_id % 7 IN (1, 2, 4, 5))"""


def sql_case(col: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in pairs) + " END"


SQL_CLEAN = f"""clean AS (
  SELECT doc_id, line_no, lang, {sql_case('lang', ORACLE_LINE_FILES)} AS file_name,
         {sql_jtrim('value')} AS entity_name
  FROM lines)"""
SQL_CLEAN_KEPT = "clean_kept AS (SELECT * FROM clean WHERE entity_name <> '' AND NOT starts_with(entity_name, '#'))"

# Paged document feeds: page = doc_id div page size; three damaged sources.
_FAILED, _TRUNC, _MISSING = "'src3'", "'src4'", "'src5'"
SQL_FEEDS = f"""fp AS (SELECT *, CAST(post_id // 100 AS BIGINT) AS page FROM posts),
feeds AS (
  SELECT feed_name AS source, page, min(post_id) AS feed_id, count(*) AS n_posts,
         feed_name || '/' || CAST(page AS VARCHAR) AS name,
         printf('https://feeds.example/%s/page/%d.json', feed_name, page) AS url,
         feed_name <> {_FAILED} AS downloaded,
         feed_name NOT IN ({_FAILED}, {_TRUNC}, {_MISSING}) AS parse_ok
  FROM fp GROUP BY feed_name, page),
good AS (SELECT * FROM fp WHERE feed_name NOT IN ({_FAILED}, {_TRUNC}, {_MISSING}))"""

SQL_PROC_STATS = f"""proc AS (
  SELECT
    (SELECT count(*) FROM feeds WHERE downloaded) AS feeds_success,
    (SELECT count(*) FROM feeds WHERE NOT downloaded) AS feeds_failed,
    (SELECT count(*) FROM good) AS posts_success,
    (SELECT count(*) FROM good WHERE NOT (title <> '' AND selftext <> '')) AS posts_failed,
    (SELECT count(*) FROM good WHERE NOT (title <> '' AND selftext <> '')) AS posts_filtered,
    (SELECT coalesce(CAST(floor(CAST(sum({sql_u16('title')} + {sql_u16('selftext')}) AS DOUBLE)
                                / nullif(count(*), 0)) AS BIGINT), 0)
       FROM good WHERE title <> '' AND selftext <> '') AS avg_chars)"""

SQL_ENTRIES = r"""entries AS (
  SELECT page_id AS entry_index, url,
         CASE WHEN instr(url, '#') > 0 THEN NULL ELSE regexp_extract(html, '<title>(.*?)</title>', 1) END AS name
  FROM pages)"""


# ====================================================== Spark helpers =======

def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return tables.table(spark, sf, "documents")


def _doc_posts(spark: SparkSession, sf: str) -> DataFrame:
    return tables.documents_as_posts(_docs(spark, sf))


#: Session setting: posts are spread over so many partitions before tokenising. Unset (as on any
#: table with many row groups) nothing is moved; local runs over one-row-group files set it.
SPREAD_CONF = "spark.feedlens.tokenizePartitions"


def _spread(kept: DataFrame, *key: str) -> DataFrame:
    n = kept.sparkSession.conf.get(SPREAD_CONF, None)
    return kept.repartition(int(n), *key) if n else kept


def _doc_kept(spark: SparkSession, sf: str) -> DataFrame:
    return posts.live_filter(_doc_posts(spark, sf))


def _literal(spark: SparkSession, force: str | None = None) -> detect.PreparedDictionary:
    if force is None:
        return detect.prepare_literal_dictionary(spark, tables.LITERAL_DICTIONARY)
    return detect.prepare_dictionary(tables.literal_dictionary(spark), force=force)


def _doc_hits(spark: SparkSession, sf: str, fields=detect.POST_FIELDS) -> DataFrame:
    return detect.entity_hits(_spread(_doc_kept(spark, sf), "post_id"), _literal(spark), fields=fields)


def _doc_counts(spark: SparkSession, sf: str) -> DataFrame:
    return detect.entity_counts(_spread(_doc_kept(spark, sf), "post_id"), _literal(spark))


def _doc_feeds(spark: SparkSession, sf: str) -> DataFrame:
    return posts.parse_feeds(tables.feeds_from_documents(_docs(spark, sf)))


def _page_entries(spark: SparkSession, sf: str) -> DataFrame:
    e = tables.subscription_entries_from_pages(tables.table(spark, sf, "pages"))
    return subsrc.validate_entries(e.withColumn("entry", subsrc.parse_entry(F.col("entry_json"))))


def _line_missing(spark: SparkSession, sf: str) -> DataFrame:
    return dictsrc.missing_dictionary_files(tables.dictionary_files_from_documents(_docs(spark, sf)))


# ====================================================== step 1: text ========

SQL_SPACED = """spaced AS (
  SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN replace(text, ' ', chr(9)) WHEN 2 THEN replace(text, ' ', chr(11))
                                 WHEN 3 THEN replace(text, ' ', chr(12)) WHEN 4 THEN replace(text, ' ', chr(13))
                                 ELSE text END AS text FROM documents)"""


@register(
    "tokens_per_document",
    sql_with(SQL_SPACED)
    + f"""SELECT doc_id,
       CAST(len(list_filter(regexp_split_to_array(lower(text), {WS_SQL}), lambda t: t <> '')) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct(list_filter(regexp_split_to_array(lower(text), {WS_SQL}), lambda t: t <> ''))) AS BIGINT)
         AS n_distinct_tokens
FROM spaced""",
)
def q_tokens_per_document(spark, sf):
    t = tokens("text")
    return tables.spaced_documents(_docs(spark, sf)).select(
        "doc_id",
        F.size(t).cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct(t)).cast("bigint").alias("n_distinct_tokens"),
    )


@register(
    "java_trim_lengths",
    sql_with(SQL_LINES)
    + f"SELECT doc_id, line_no, CAST(length(value) AS BIGINT) AS n_chars, "
    f"CAST(length({sql_jtrim('value')}) AS BIGINT) AS trimmed_chars FROM lines",
)
def q_java_trim_lengths(spark, sf):
    lines = tables.document_lines(_docs(spark, sf))
    return lines.select(
        "doc_id",
        "line_no",
        F.length("value").cast("bigint").alias("n_chars"),
        F.length(java_trim("value")).cast("bigint").alias("trimmed_chars"),
    )


@register(
    "utf16_lengths",
    "WITH astral AS (SELECT doc_id, text || repeat(chr(128512), CAST(doc_id % 3 AS INTEGER)) AS text FROM documents) "
    f"SELECT doc_id, CAST(length(text) AS BIGINT) AS n_code_points, CAST({sql_u16('text')} AS BIGINT) AS n_utf16 "
    "FROM astral",
)
def q_utf16_lengths(spark, sf):
    return tables.astral_documents(_docs(spark, sf)).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_code_points"),
        utf16_length("text").alias("n_utf16"),
    )


# ================================================= step 2: dictionary ======

@register(
    "dictionary_clean",
    sql_with(SQL_LINES, SQL_CLEAN, SQL_CLEAN_KEPT) + "SELECT doc_id, line_no, file_name, entity_name FROM clean_kept",
)
def q_dictionary_clean(spark, sf):
    lines = tables.dictionary_lines_from_documents(_docs(spark, sf))
    return dictsrc.clean_lines(lines).select("doc_id", "line_no", "file_name", "entity_name")


@register(
    "dictionary_by_type",
    sql_with(SQL_LINES, SQL_CLEAN, SQL_CLEAN_KEPT, FILE_MAP_CTE)
    + "SELECT c.doc_id, c.line_no, m.file_order, m.entity_type, c.entity_name "
    "FROM clean_kept c JOIN fmap m ON c.file_name = m.file_name",
)
def q_dictionary_by_type(spark, sf):
    lines = tables.dictionary_lines_from_documents(_docs(spark, sf))
    typed = dictsrc.type_by_file(dictsrc.clean_lines(lines))
    return typed.select("doc_id", "line_no", "file_order", "entity_type", "entity_name")


@register(
    "dictionary_missing_files",
    sql_with(SQL_LINES, SQL_CLEAN, FILE_MAP_CTE)
    + "SELECT file_order, file_name, entity_type FROM fmap "
    "WHERE file_name NOT IN (SELECT DISTINCT file_name FROM clean WHERE file_name IS NOT NULL)",
)
def q_dictionary_missing_files(spark, sf):
    return _line_missing(spark, sf)


@register(
    "entity_type_fallback",
    sql_with(SQL_LINES, SQL_CLEAN, SQL_CLEAN_KEPT)
    + "SELECT doc_id, line_no, CASE WHEN t IN ("
    + ", ".join(_q(x) for x in ORACLE_TYPES)
    + ") THEN t ELSE 'Person' END AS entity_type, entity_name FROM (SELECT *, "
    + sql_case("lang", ORACLE_LINE_TYPES)
    + " AS t FROM clean_kept)",
)
def q_entity_type_fallback(spark, sf):
    lines = tables.requested_types_from_documents(_docs(spark, sf))
    return dictsrc.clean_lines(lines).select(
        "doc_id", "line_no", dictsrc.with_fallback_type("requested_type").alias("entity_type"), "entity_name"
    )


# ====================================================== step 3: posts =======

# All posts, and a post with a body of white space only for every eleventh.
_BLANK_POSTS_SQL = sql_with(sql_doc_posts()).rstrip() + """,
more AS (
  SELECT post_id, feed_name, title, selftext FROM posts
  UNION ALL SELECT -1 - post_id, feed_name, title, chr(9) || ' ' || chr(10) FROM posts WHERE post_id % 11 = 0)
"""


@register("posts_live", _BLANK_POSTS_SQL + "SELECT post_id, feed_name, title, selftext FROM more WHERE title <> '' AND selftext <> ''")
def q_posts_live(spark, sf):
    return posts.live_filter(tables.with_blank_posts(_doc_posts(spark, sf)))


@register(
    "posts_strict",
    _BLANK_POSTS_SQL + "SELECT post_id, feed_name, title, selftext FROM more "
    f"WHERE title <> '' AND selftext <> '' AND {sql_jtrim('selftext')} <> ''",
)
def q_posts_strict(spark, sf):
    return posts.strict_filter(tables.with_blank_posts(_doc_posts(spark, sf)))


@register(
    "post_counts",
    sql_with(sql_doc_posts())
    + "SELECT count(*) AS posts_total, count(*) FILTER (WHERE title <> '' AND selftext <> '') AS posts_kept, "
    "count(*) - count(*) FILTER (WHERE title <> '' AND selftext <> '') AS posts_dropped FROM posts",
)
def q_post_counts(spark, sf):
    return posts.post_counts(_doc_posts(spark, sf)).select("posts_total", "posts_kept", "posts_dropped")


@register(
    "avg_post_chars",
    sql_with(sql_doc_posts(), SQL_KEPT)
    + f"SELECT coalesce(CAST(floor(CAST(sum({sql_u16('title')} + {sql_u16('selftext')}) AS DOUBLE) "
    "/ nullif(count(*), 0)) AS BIGINT), 0) AS avg_chars FROM kept",
)
def q_avg_post_chars(spark, sf):
    return posts.avg_post_chars(_doc_posts(spark, sf))


# ===================================================== step 4: detect =======

_HITS_SQL = sql_with(sql_doc_posts(), SQL_KEPT, sql_words(), LITERAL_DICT_CTE, sql_hits())


@register(
    "entity_hits_title",
    sql_with(sql_doc_posts(), SQL_KEPT, sql_words(fields=("title",)), LITERAL_DICT_CTE, sql_hits())
    + "SELECT post_id, entity_type, entity_name FROM hits",
)
def q_entity_hits_title(spark, sf):
    return _doc_hits(spark, sf, fields=("title",)).select("post_id", "entity_type", "entity_name")


@register(
    "entity_hits_body",
    sql_with(sql_doc_posts(), SQL_KEPT, sql_words(fields=("selftext",)), LITERAL_DICT_CTE, sql_hits())
    + "SELECT post_id, entity_type, entity_name FROM hits",
)
def q_entity_hits_body(spark, sf):
    return _doc_hits(spark, sf, fields=("selftext",)).select("post_id", "entity_type", "entity_name")


@register("entity_hits", _HITS_SQL + "SELECT post_id, field, entity_type, entity_name FROM hits")
def q_entity_hits(spark, sf):
    return _doc_hits(spark, sf)


@register("entity_hits_shuffle", _HITS_SQL + "SELECT post_id, field, entity_type, entity_name FROM hits")
def q_entity_hits_shuffle(spark, sf):
    """The same hits through the non-broadcast (shuffle join) plan."""
    return detect.entity_hits(_spread(_doc_kept(spark, sf), "post_id"), _literal(spark, force="shuffle"))


@register(
    "entity_describe",
    _HITS_SQL + "SELECT post_id, field, printf('[%s] %s', entity_type, entity_name) AS describe FROM hits",
)
def q_entity_describe(spark, sf):
    return aggregate.describe_hits(_doc_hits(spark, sf))


# ================================================== step 5: aggregate =======

@register("entity_counts", SQL_DOC_COUNTS + "SELECT entity_type, entity_name, n FROM counts")
def q_entity_counts(spark, sf):
    return _doc_counts(spark, sf)


@register(
    "entity_counts_from_hits",
    SQL_DOC_COUNTS + "SELECT entity_type, entity_name, n FROM counts",
)
def q_entity_counts_from_hits(spark, sf):
    """A1 written as the reference does it: hits, then count by (type, name)."""
    return aggregate.entity_counts_from_hits(_doc_hits(spark, sf))


@register(
    "type_counts_from_hits",
    _HITS_SQL
    + "SELECT entity_type, CAST(count(*) AS BIGINT) AS n FROM hits GROUP BY entity_type "
    "UNION ALL SELECT 'total', CAST(count(*) AS BIGINT) FROM hits",
)
def q_type_counts_from_hits(spark, sf):
    return aggregate.type_counts_from_hits(_doc_hits(spark, sf))


@register(
    "type_counts_from_counts",
    SQL_DOC_COUNTS + "SELECT entity_type, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY entity_type",
)
def q_type_counts_from_counts(spark, sf):
    return aggregate.type_counts(_doc_counts(spark, sf))


@register("total_entities", SQL_DOC_COUNTS + "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM counts")
def q_total_entities(spark, sf):
    return aggregate.total_entities(_doc_counts(spark, sf))


@register("type_counts_with_total", SQL_DOC_COUNTS.rstrip() + ",\n" + SQL_TWT + "\nSELECT entity_type, n FROM twt")
def q_type_counts_with_total(spark, sf):
    return aggregate.type_counts_with_total(_doc_counts(spark, sf))


@register(
    "type_stats_zero_filled",
    SQL_DOC_COUNTS.rstrip() + ",\n" + SQL_TWT + ",\n" + SQL_TYPE_STATS + "\nSELECT ordinal, entity_type, n FROM type_stats",
)
def q_type_stats_zero_filled(spark, sf):
    return aggregate.type_stats_from_counts(_doc_counts(spark, sf))


@register("top_entities", SQL_DOC_COUNTS + sql_top(10))
def q_top_entities(spark, sf):
    return aggregate.top_entities(_doc_counts(spark, sf), 10)


@register("top_entities_k2", SQL_DOC_COUNTS + sql_top(2))
def q_top_entities_k2(spark, sf):
    return aggregate.top_entities(_doc_counts(spark, sf), 2)


# ====================================================== step 6: feeds =======

@register("subscriptions_valid", sql_with(SQL_ENTRIES) + "SELECT entry_index, name, url FROM entries WHERE name IS NOT NULL")
def q_subscriptions_valid(spark, sf):
    return subsrc.valid_subscriptions(_page_entries(spark, sf)).select("entry_index", "name", "url")


@register("subscriptions_rejected", sql_with(SQL_ENTRIES) + "SELECT entry_index, url FROM entries WHERE name IS NULL")
def q_subscriptions_rejected(spark, sf):
    return subsrc.rejected_subscriptions(_page_entries(spark, sf)).select("entry_index", "url")


@register(
    "feed_fetch_outcomes",
    sql_with(sql_doc_posts(), SQL_FEEDS)
    + "SELECT count(*) FILTER (WHERE downloaded) AS feeds_success, count(*) FILTER (WHERE NOT downloaded) AS feeds_failed, "
    "count(*) FILTER (WHERE downloaded AND NOT parse_ok) AS feeds_parse_failed FROM feeds",
)
def q_feed_fetch_outcomes(spark, sf):
    return stats.feed_outcomes(_doc_feeds(spark, sf))


@register(
    "feed_parse_outcomes",
    sql_with(sql_doc_posts(), SQL_FEEDS)
    + "SELECT feed_id, name AS feed_name, downloaded, parse_ok, "
    "CAST(CASE WHEN parse_ok THEN n_posts ELSE 0 END AS BIGINT) AS n_posts FROM feeds",
)
def q_feed_parse_outcomes(spark, sf):
    return _doc_feeds(spark, sf).select(
        "feed_id", "feed_name", "downloaded", "parse_ok", F.size("posts").cast("bigint").alias("n_posts")
    )


@register(
    "feed_posts",
    sql_with(sql_doc_posts(), SQL_FEEDS)
    + "SELECT feed_id, post_pos, title, selftext FROM ("
    "SELECT min(post_id) OVER (PARTITION BY feed_name, page) AS feed_id, "
    "CAST(row_number() OVER (PARTITION BY feed_name, page ORDER BY post_id) - 1 AS BIGINT) AS post_pos, "
    "title, selftext FROM good)",
)
def q_feed_posts(spark, sf):
    return posts.explode_posts(_doc_feeds(spark, sf)).select("feed_id", "post_pos", "title", "selftext")


# ===================================================== step 7: reports ======

@register(
    "processing_stats",
    sql_with(sql_doc_posts(), SQL_FEEDS, SQL_PROC_STATS)
    + "SELECT feeds_success, feeds_failed, posts_success, posts_failed, posts_filtered, avg_chars FROM proc",
)
def q_processing_stats(spark, sf):
    return stats.processing_stats(_doc_feeds(spark, sf))


def _stat_lines_sql() -> str:
    parts = [
        f"SELECT {i} AS ordinal, {_q(key)} AS metric, CAST({col} AS BIGINT) AS value, "
        f"printf('%s: %d', {_q(label)}, {col}) AS line FROM proc"
        for i, (key, label, col) in enumerate(ORACLE_STATS, 1)
    ]
    return sql_with(sql_doc_posts(), SQL_FEEDS, SQL_PROC_STATS) + "\nUNION ALL\n".join(parts)


@register("processing_stats_lines", _stat_lines_sql())
def q_processing_stats_lines(spark, sf):
    return reports.processing_stats_lines(stats.processing_stats(_doc_feeds(spark, sf)))


@register(
    "entity_lines",
    SQL_DOC_COUNTS.rstrip() + ",\ntop AS (" + sql_top(10) + ")\n"
    f"SELECT rank, printf({ENTITY_LINE_SQL}, entity_type, entity_name, n) AS line FROM top",
)
def q_entity_lines(spark, sf):
    return reports.entity_lines(aggregate.top_entities(_doc_counts(spark, sf), 10))


@register(
    "type_lines",
    SQL_DOC_COUNTS.rstrip() + ",\n" + SQL_TWT + ",\n" + SQL_TYPE_STATS + "\n"
    f"SELECT ordinal, CASE WHEN ordinal = 0 THEN printf({TOTAL_LINE_SQL}, n) "
    f"ELSE printf({TYPE_LINE_SQL}, entity_type, n) END AS line FROM type_stats",
)
def q_type_lines(spark, sf):
    return reports.type_lines(aggregate.type_stats_from_counts(_doc_counts(spark, sf)))


@register(
    "entity_report_text",
    SQL_DOC_COUNTS.rstrip() + ",\ntop AS (" + sql_top(10) + ")\n"
    f"SELECT {ENTITY_HEADER_SQL} || chr(10) || coalesce(string_agg(printf({ENTITY_LINE_SQL}, entity_type, entity_name, n), "
    "chr(10) ORDER BY rank), '') AS text FROM top",
)
def q_entity_report_text(spark, sf):
    """K4 + X13: the whole report as one text."""
    lines = reports.entity_lines(aggregate.top_entities(_doc_counts(spark, sf), 10))
    return reports.rendered(lines, "rank", fmt.ENTITY_HEADER)


@register(
    "type_report_text",
    SQL_DOC_COUNTS.rstrip() + ",\n" + SQL_TWT + ",\n" + SQL_TYPE_STATS + "\n"
    f"SELECT {TYPE_HEADER_SQL} || chr(10) || max(CASE WHEN ordinal = 0 THEN printf({TOTAL_LINE_SQL}, n) END) || chr(10) "
    f"|| {TYPE_SUBHEADER_SQL} || chr(10) || string_agg(printf({TYPE_LINE_SQL}, entity_type, n), chr(10) ORDER BY ordinal) "
    "FILTER (WHERE ordinal > 0) AS text FROM type_stats",
)
def q_type_report_text(spark, sf):
    """K3 + X13: the whole report as one text."""
    lines = reports.type_lines(aggregate.type_stats_from_counts(_doc_counts(spark, sf)))
    return reports.rendered(lines, "ordinal", fmt.TYPE_HEADER, subheader_after=1)


_QC_SQL = (
    sql_with(sql_doc_posts(), SQL_FEEDS, SQL_ENTRIES, SQL_LINES, SQL_CLEAN, FILE_MAP_CTE)
    + """, missing AS (
  SELECT * FROM fmap WHERE file_name NOT IN (SELECT DISTINCT file_name FROM clean WHERE file_name IS NOT NULL)),
bad_files AS (SELECT DISTINCT entry_index // 50 AS bucket FROM entries WHERE (entry_index // 50) % 4 IN (2, 3)),
checks(check_id, check_name, n) AS (
  SELECT 'Q1', 'subscriptions_file_found', 0
  UNION ALL SELECT 'Q2', 'subscriptions_file_invalid', (SELECT count(*) FROM bad_files)
  UNION ALL SELECT 'Q3', 'valid_subscriptions', (SELECT count(*) FROM entries WHERE name IS NOT NULL)
  UNION ALL SELECT 'Q4', 'entities_dir_found', 1
  UNION ALL SELECT 'Q5', 'posts_after_filter', (SELECT count(*) FROM good WHERE title <> '' AND selftext <> '')
  UNION ALL SELECT 'Q6', 'malformed_subscriptions', (SELECT count(*) FROM entries WHERE name IS NULL)
  UNION ALL SELECT 'Q7', 'failed_downloads', (SELECT count(*) FROM feeds WHERE NOT downloaded)
  UNION ALL SELECT 'Q8', 'failed_parses', (SELECT count(*) FROM feeds WHERE downloaded AND NOT parse_ok)
  UNION ALL SELECT 'S6', 'missing_dictionary_files', (SELECT count(*) FROM missing))
SELECT check_id, check_name,
       CASE WHEN check_id IN ('Q3', 'Q5') THEN n > 0 ELSE n = 0 END AS ok,
       CAST(n AS BIGINT) AS n
FROM checks"""
)


@register("quality_checks", _QC_SQL)
def q_quality_checks(spark, sf):
    """Files that Spark wrote from ``pages`` (some invalid); the subscriptions path exists, the
    entities path does not."""
    path = tables.write_subscription_files(tables.table(spark, sf, "pages"), config.scratch_path(spark, "subscriptions"))
    files = subsrc.read_subscription_files(spark, path)
    listing = quality.path_listing(spark, [("Q1", path), ("Q4", config.scratch_path(spark, "no-entities"))])
    return quality.quality_checks(files, _page_entries(spark, sf), _line_missing(spark, sf), _doc_feeds(spark, sf), listing)


_WARN_SQL = (
    sql_with(sql_doc_posts(), SQL_FEEDS, SQL_ENTRIES, SQL_LINES, SQL_CLEAN, FILE_MAP_CTE)
    + """, missing AS (
  SELECT * FROM fmap WHERE file_name NOT IN (SELECT DISTINCT file_name FROM clean WHERE file_name IS NOT NULL))
"""
    + f"""SELECT 'Q6' AS check_id, {MALFORMED_SQL} AS message FROM entries WHERE name IS NULL
UNION ALL SELECT 'Q7', printf({DOWNLOAD_SQL}, name, url) FROM feeds WHERE NOT downloaded
UNION ALL SELECT 'Q8', printf({PARSE_SQL}, name) FROM feeds WHERE downloaded AND NOT parse_ok
UNION ALL SELECT 'S6', printf({MISSING_FILE_SQL}, file_name) FROM missing"""
)


@register("quality_warnings", _WARN_SQL)
def q_quality_warnings(spark, sf):
    return quality.warnings(_page_entries(spark, sf), _doc_feeds(spark, sf), _line_missing(spark, sf))


# ========================================================= step 8: scale ====

_BENCH_DICT_CTE = f"""btok AS (
  SELECT DISTINCT tok FROM (SELECT unnest(regexp_split_to_array(text, {WS_SQL})) AS tok FROM benchmark) WHERE tok <> ''),
bclean AS (SELECT {sql_jtrim('tok')} AS entity_name FROM btok),
dict AS (
  SELECT (['Person', 'Organization', 'University', 'Place', 'ProgrammingLanguage'])[length(entity_name) % 5 + 1]
           AS entity_type, entity_name
  FROM bclean WHERE entity_name <> '' AND NOT starts_with(entity_name, '#'))"""

_LARGE_COUNTS_SQL = sql_with(sql_doc_posts(), SQL_KEPT, sql_words(), _BENCH_DICT_CTE, sql_hits(), SQL_COUNTS)


def _bench_dict(spark: SparkSession, sf: str, force: str | None = None) -> detect.PreparedDictionary:
    return detect.prepare_dictionary(tables.benchmark_dictionary(tables.table(spark, sf, "benchmark")), force=force)


@register("entity_counts_large_dictionary", _LARGE_COUNTS_SQL + "SELECT entity_type, entity_name, n FROM counts")
def q_entity_counts_large_dictionary(spark, sf):
    return detect.entity_counts(_spread(_doc_kept(spark, sf), "post_id"), _bench_dict(spark, sf))


@register(
    "entity_counts_large_dictionary_aggregate_first",
    _LARGE_COUNTS_SQL + "SELECT entity_type, entity_name, n FROM counts",
)
def q_entity_counts_large_dictionary_aggregate_first(spark, sf):
    """Large dictionary through the no-broadcast plan (shuffle by word first)."""
    return detect.entity_counts(_spread(_doc_kept(spark, sf), "post_id"), _bench_dict(spark, sf, force="shuffle"), plan="aggregate_first")


@register("entity_counts_aggregate_first", SQL_DOC_COUNTS + "SELECT entity_type, entity_name, n FROM counts")
def q_entity_counts_aggregate_first(spark, sf):
    return detect.entity_counts(_spread(_doc_kept(spark, sf), "post_id"), _literal(spark), plan="aggregate_first")


# ================================================ step 9: second inputs =====

@register(
    "top_entities_pages",
    sql_with(SQL_PAGE_POSTS, SQL_KEPT, sql_words(), LITERAL_DICT_CTE, sql_hits(), SQL_COUNTS) + sql_top(10),
)
def q_top_entities_pages(spark, sf):
    kept = posts.live_filter(tables.pages_as_posts(tables.table(spark, sf, "pages")))
    return aggregate.top_entities(detect.entity_counts(_spread(kept, "post_id"), _literal(spark)), 10)


@register(
    "top_entities_conversations",
    sql_with(SQL_CONV_POSTS, SQL_KEPT, sql_words("conv_id, turn"), LITERAL_DICT_CTE, sql_hits("conv_id, turn"), SQL_COUNTS)
    + sql_top(10),
)
def q_top_entities_conversations(spark, sf):
    kept = posts.live_filter(tables.conversations_as_posts(tables.table(spark, sf, "conversations")))
    return aggregate.top_entities(detect.entity_counts(kept, _literal(spark)), 10)


# ===================================================== streaming ===========

_GOOD_POSTS_SQL = sql_with(sql_doc_posts(), SQL_FEEDS).rstrip() + """,
kept AS (SELECT post_id, title, selftext FROM good WHERE title <> '' AND selftext <> ''),
"""


@register(
    "stream_entity_counts",
    _GOOD_POSTS_SQL + sql_words() + ",\n" + LITERAL_DICT_CTE + ",\n" + sql_hits() + ",\n" + SQL_COUNTS
    + "\nSELECT entity_type, entity_name, n FROM counts",
)
def q_stream_entity_counts(spark, sf):
    """Document feeds landed as parquet, counted by a Structured Streaming query."""
    from feedlens.streaming.feeds import landed_feed_stream, run_available

    landed = feedsrc.land_to(tables.feeds_from_documents(_docs(spark, sf)), "stream-feeds")
    out, checkpoint = config.scratch_path(spark, "stream-counts"), config.scratch_path(spark, "stream-checkpoint")
    return run_available(landed_feed_stream(spark, landed), _literal(spark), out, checkpoint)


@register("entity_counts_post_lines", SQL_DOC_COUNTS + "SELECT entity_type, entity_name, n FROM counts")
def q_entity_counts_post_lines(spark, sf):
    """Posts landed as a JSON Lines bulk dump, read line by line, then counted."""
    path = config.scratch_path(spark, "post-lines")
    _doc_posts(spark, sf).select(F.to_json(F.struct("title", "selftext")).alias("value")).write.text(path)
    lines = feedsrc.read_post_lines(spark, path).where("line_ok")
    return detect.entity_counts(posts.live_filter(lines), _literal(spark))


# ================================================ step 10: file sources =====

_BUCKETS_SQL = sql_with(SQL_ENTRIES).rstrip() + """,
buckets AS (SELECT *, CAST(entry_index // 50 AS BIGINT) AS bucket,
                   (entry_index // 50) % 4 NOT IN (2, 3) AS file_ok FROM entries)
"""


def _subscription_files(spark: SparkSession, sf: str) -> DataFrame:
    path = tables.write_subscription_files(tables.table(spark, sf, "pages"), config.scratch_path(spark, "subscriptions"))
    return subsrc.read_subscription_files(spark, path)


def _bucket(column: str):
    return F.regexp_extract(column, r"bucket=(\d+)", 1).cast("bigint")


@register(
    "subscription_files",
    _BUCKETS_SQL + "SELECT bucket, file_ok, CAST(CASE WHEN file_ok THEN count(*) ELSE 0 END AS BIGINT) AS n_entries "
    "FROM buckets GROUP BY bucket, file_ok",
)
def q_subscription_files(spark, sf):
    """S1 + N5 on array files that Spark wrote; some are no arrays."""
    n = F.when(F.col("file_ok"), F.size("entries")).otherwise(0).cast("bigint")
    return _subscription_files(spark, sf).select(_bucket("file").alias("bucket"), "file_ok", n.alias("n_entries"))


@register(
    "subscription_file_entries",
    _BUCKETS_SQL + "SELECT bucket, CAST(entry_index % 50 AS INTEGER) AS entry_index, name, url, name IS NOT NULL AS is_valid "
    "FROM buckets WHERE file_ok",
)
def q_subscription_file_entries(spark, sf):
    entries = subsrc.file_entries(_subscription_files(spark, sf))
    return entries.select(_bucket("file").alias("bucket"), "entry_index", "name", "url", "is_valid")


@register(
    "dictionary_directory",
    sql_with(SQL_LINES, SQL_CLEAN, SQL_CLEAN_KEPT, FILE_MAP_CTE)
    + "SELECT m.entity_type, c.entity_name, CAST(count(*) AS BIGINT) AS n "
    "FROM clean_kept c JOIN fmap m ON c.file_name = m.file_name GROUP BY m.entity_type, c.entity_name",
)
def q_dictionary_directory(spark, sf):
    """S4 + S5 + F5 + P3 + U1 on a directory that Spark wrote; duplicates are kept."""
    path = tables.write_dictionary_dir(_docs(spark, sf), config.scratch_path(spark, "entities"))
    return dictsrc.load_dictionary(spark, path).groupBy("entity_type", "entity_name").agg(F.count(F.lit(1)).alias("n"))


@register(
    "dictionary_directory_missing",
    sql_with(FILE_MAP_CTE)
    + "SELECT file_order, file_name, entity_type FROM fmap WHERE file_name IN ('universities.txt', 'organizations.txt')",
)
def q_dictionary_directory_missing(spark, sf):
    path = tables.write_dictionary_dir(_docs(spark, sf), config.scratch_path(spark, "entities"))
    return dictsrc.missing_dictionary_files(dictsrc.present_dictionary_files(spark, path))


@register(
    "type_stats_extended",
    sql_with(SQL_LINES, SQL_CLEAN, SQL_CLEAN_KEPT, FILE_MAP_CTE).rstrip()
    + """,
more AS (SELECT file_name, entity_type FROM fmap UNION ALL SELECT 'notas.txt', 'Song'),
typed AS (SELECT m.entity_type FROM clean_kept c JOIN more m ON c.file_name = m.file_name),
labels(ordinal, entity_type) AS (VALUES (0, 'total'), (1, 'Person'), (2, 'Organization'), (3, 'University'), (4, 'Place'),
                                        (5, 'Technology'), (6, 'ProgrammingLanguage'), (7, 'Song'))
SELECT ordinal, entity_type, CAST(CASE WHEN ordinal = 0 THEN (SELECT count(*) FROM typed)
       ELSE (SELECT count(*) FROM typed t WHERE t.entity_type = labels.entity_type) END AS BIGINT) AS n FROM labels""",
)
def q_type_stats_extended(spark, sf):
    """A further type with a file of its own, by a row in each list; entries counted by type."""
    path = tables.write_dictionary_dir(_docs(spark, sf), config.scratch_path(spark, "entities"))
    found = dictsrc.load_dictionary(spark, path, [*DICTIONARY_FILES, ("notas.txt", "Song")])
    counts = found.groupBy("entity_type", "entity_name").agg(F.count(F.lit(1)).alias("n"))
    return aggregate.type_stats_from_counts(counts, [*ENTITY_TYPES, "Song"])


@register(
    "feeds_fetched",
    sql_with(sql_doc_posts(), SQL_FEEDS)
    + "SELECT feed_id, name AS feed_name, downloaded, parse_ok, "
    "CAST(CASE WHEN parse_ok THEN n_posts ELSE 0 END AS BIGINT) AS n_posts FROM feeds",
)
def q_feeds_fetched(spark, sf):
    """S3: feed files fetched by url, some of which do not exist, then parsed."""
    subs = tables.write_feed_files(_docs(spark, sf), config.scratch_path(spark, "feed-files"))
    parsed = posts.parse_feeds(feedsrc.fetch_feeds(subs))
    return parsed.select("feed_id", "feed_name", "downloaded", "parse_ok", F.size("posts").cast("bigint").alias("n_posts"))


@register("top_entities_large_dictionary", _LARGE_COUNTS_SQL + sql_top(500))
def q_top_entities_large_dictionary(spark, sf):
    """T1 where the limit cuts and equal counts are told apart by type and name."""
    return aggregate.top_entities(detect.entity_counts(_doc_kept(spark, sf), _bench_dict(spark, sf)), 500)


@register("entity_hits_large_dictionary_shuffle", sql_with(sql_doc_posts(), SQL_KEPT, sql_words(), _BENCH_DICT_CTE, sql_hits())
          + "SELECT post_id, field, entity_type, entity_name FROM hits")
def q_entity_hits_large_dictionary_shuffle(spark, sf):
    """Per-post hits of a large dictionary through the salted sort-merge join."""
    return detect.entity_hits(_doc_kept(spark, sf), _bench_dict(spark, sf, force="shuffle"))


# ============================================== step 11: the whole run =======

PROCESSING_HEADER_SQL = "'============ ESTADÍSTICAS DE PROCESAMIENTO ============'"
_RUN_CTES = (
    sql_with(sql_doc_posts(), SQL_FEEDS, SQL_PROC_STATS).rstrip()
    + ",\nkept AS (SELECT post_id, title, selftext FROM good WHERE title <> '' AND selftext <> ''),\n"
    + ",\n".join([sql_words(), _BENCH_DICT_CTE, sql_hits(), SQL_COUNTS, SQL_TWT, SQL_TYPE_STATS])
    + ",\ntop AS (" + sql_top(10) + ")\n"
)
_RUN_STATS_LINES = " || chr(10) || ".join(f"printf('%s: %d', {_q(label)}, {col})" for _, label, col in ORACLE_STATS)


def _run_inputs(spark: SparkSession, sf: str) -> tuple[str, str]:
    return tables.write_run_inputs(
        _docs(spark, sf), tables.table(spark, sf, "pages"), tables.table(spark, sf, "benchmark"), config.scratch_path(spark, "run-inputs")
    )


@register(
    "end_to_end_run",
    _RUN_CTES
    + f"""SELECT 1 AS ordinal, 'processing' AS report, {PROCESSING_HEADER_SQL} || chr(10) || {_RUN_STATS_LINES} AS text FROM proc
UNION ALL SELECT 2, 'entities', {ENTITY_HEADER_SQL} || chr(10)
  || coalesce(string_agg(printf({ENTITY_LINE_SQL}, entity_type, entity_name, n), chr(10) ORDER BY rank), '') FROM top
UNION ALL SELECT 3, 'types', {TYPE_HEADER_SQL} || chr(10) || max(CASE WHEN ordinal = 0 THEN printf({TOTAL_LINE_SQL}, n) END) || chr(10)
  || {TYPE_SUBHEADER_SQL} || chr(10) || string_agg(printf({TYPE_LINE_SQL}, entity_type, n), chr(10) ORDER BY ordinal)
  FILTER (WHERE ordinal > 0) FROM type_stats""",
)
def q_end_to_end_run(spark, sf):
    """The reference's whole workload on files: subscriptions, fetch by ``file:`` urls, parse,
    statistics, entities of the dictionary directory, and the three reports."""
    result = run_analysis(spark, *_run_inputs(spark, sf), top_k=10)
    stat_lines = reports.processing_stats_lines(result.processing_stats)
    texts = [
        ("processing", reports.rendered(stat_lines, "ordinal", fmt.PROCESSING_HEADER)),
        ("entities", reports.rendered(reports.entity_lines(result.top_entities), "rank", fmt.ENTITY_HEADER)),
        ("types", reports.rendered(reports.type_lines(result.type_stats), "ordinal", fmt.TYPE_HEADER, subheader_after=1)),
    ]
    parts = [text.select(F.lit(i).alias("ordinal"), F.lit(name).alias("report"), "text") for i, (name, text) in enumerate(texts, 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "quarantined",
    sql_with(sql_doc_posts(), SQL_FEEDS).rstrip()
    + """,
entries AS (
  SELECT feed_id // 5000 AS bucket, 0 AS kind, feed_id AS id, name, downloaded, parse_ok FROM feeds
  UNION ALL SELECT page_id // 5000, 1, page_id, NULL, NULL, NULL FROM pages WHERE instr(url, '#') > 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY kind, id) - 1 AS entry_index FROM entries)
SELECT CASE WHEN kind = 1 THEN 'malformed_subscription' WHEN NOT downloaded THEN 'failed_download' ELSE 'failed_parse' END AS reason,
       CAST(bucket AS BIGINT) AS bucket, CAST(entry_index AS BIGINT) AS entry_index, name
FROM placed WHERE kind = 1 OR NOT parse_ok""",
)
def q_quarantined(spark, sf):
    """Q6, Q7, Q8 records written as a table by reason and read again."""
    subscriptions, _ = _run_inputs(spark, sf)
    subs = subsrc.read_subscriptions(spark, subscriptions)
    parsed = feedsrc.land(posts.parse_feeds(feedsrc.fetch_feeds(subs.valid)).drop("content"), "quarantine-feeds")
    path = quality.write_quarantine(quality.quarantine(subs.validated, parsed), config.scratch_path(spark, "quarantine"))
    return spark.read.parquet(path).select("reason", _bucket("file").alias("bucket"), "entry_index", "name")


@register("top_entities_ranked", _LARGE_COUNTS_SQL + sql_top(1_000_000))
def q_top_entities_ranked(spark, sf):
    """T1 for a k far beyond a report: ranked in parallel."""
    return aggregate.top_entities(detect.entity_counts(_doc_kept(spark, sf), _bench_dict(spark, sf)), 1_000_000)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
