"""Adapters from the benchmark parquet tables to this engine's inputs.

The engine's own inputs are feeds, subscription files and dictionary files.
The shared test tables (``documents``, ``pages``, ``conversations``,
``benchmark``) are mapped onto them here, by Spark, so that every registered
query reads the given tables and its work grows with them:

* posts:        title = first line of a text, selftext = the rest
* feeds:        documents paged per source (at most ``page_size`` posts per
                feed, like an API page), serialised to the feed JSON shape,
                with three sources damaged on purpose
* entries:      one subscription JSON object per page row
* dictionary:   document lines as dictionary lines, or benchmark tokens as a
                large dictionary
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.text import after_first_line, first_line, java_trim, whitespace_split
from feedlens.schemas import DICTIONARY_FILES, ENTITY_TYPES, literal_table

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# --- Fixture design for the shared tables (chosen here, not reference values).
# Literal dictionary: mixed case, a duplicate, one word under two types with
# two spellings, a multi-word name, punctuation inside a token, and a name
# that never occurs.
LITERAL_DICTIONARY = [
    ("Person", "The"),
    ("Person", "of"),
    ("Place", "In"),
    ("Place", "In"),
    ("Place", "New York"),
    ("University", "in"),
    ("ProgrammingLanguage", "en,"),
    ("Organization", "System"),
]
# Marks put on texts and lines, and lines and posts added, by ``doc_id``, so
# that trimming, comment dropping, every white-space character, the strict
# filter and UTF-16 lengths have something to do. Nothing of a text is lost.
LINE_MARKS, SPACE_MARKS, BLANK_BODY_EVERY, ASTRAL_MARKS = 7, 5, 11, 3
ASTRAL = "\U0001F600"
# Feed damage applied to paged document feeds.
FAILED_SOURCE = "src3"        # download failed: content NULL
HTML_PAGE_SOURCE = "src4"     # the whole feed wrapped in an HTML error page: not JSON
MISSING_FIELD_SOURCE = "src5" # first child has no selftext: feed rejected
FEED_PAGE_SIZE = 100
# Feed files lie in as many folders as so many hexadecimal digits can name.
FEED_FOLDER_DIGITS = 2
# Subscription files hold the entries of so many consecutive pages; of every
# four files the third is a bare object and the fourth is cut short.
SUBSCRIPTIONS_PER_FILE = 50
# Dictionary file name given to document lines, by language.
LINE_FILE_BY_LANG = [("en", "people.txt"), ("de", "languages.txt"), ("fr", "places.txt"), ("es", "notas.txt")]
# Caller-given type by language (``Persona`` is not a type: falls back).
TYPE_BY_LANG = [("en", "Person"), ("de", "ProgrammingLanguage"), ("fr", "Place"), ("es", "Persona")]
# --- end of fixture design -------------------------------------------------

# Types given to benchmark tokens by ``length(token) % 5``: those that have a dictionary file.
BENCHMARK_TYPES = [t for t in ENTITY_TYPES if t in {kind for _, kind in DICTIONARY_FILES}]


# Declared schemas of the text tables: reading with a schema skips footer
# inference (a distributed job over every file on a large input).
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "benchmark": "item_id bigint, text string",
}


# What a written feed file's subscription is made of.
FEED_URLS = "feed_id bigint, feed_name string, url string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(pairs: list[tuple[str, str]], col: str):
    m = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    return F.try_element_at(m, F.col(col))


# ---------------------------------------------------------------- posts ----

def documents_as_posts(docs: DataFrame) -> DataFrame:
    """``(post_id, feed_name, title, selftext)`` from ``documents``."""
    return docs.select(
        F.col("doc_id").alias("post_id"),
        F.col("source").alias("feed_name"),
        first_line("text").alias("title"),
        after_first_line("text").alias("selftext"),
    )


def pages_as_posts(pages: DataFrame) -> DataFrame:
    """Title from ``<title>``, body = the html with tags replaced by spaces."""
    return pages.select(
        F.col("page_id").alias("post_id"),
        F.col("url").alias("feed_name"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_replace("html", r"<[^>]*>", " ").alias("selftext"),
    )


def conversations_as_posts(conv: DataFrame) -> DataFrame:
    """One post per turn, keyed by ``(conv_id, turn)``; feed = role."""
    return conv.select(
        "conv_id",
        "turn",
        F.col("role").alias("feed_name"),
        first_line("text").alias("title"),
        after_first_line("text").alias("selftext"),
    )


# ----------------------------------------------------------- dictionary ----

def literal_dictionary(spark: SparkSession) -> DataFrame:
    return literal_table(spark, LITERAL_DICTIONARY, "entity_type string, entity_name string")


def benchmark_dictionary(bench: DataFrame) -> DataFrame:
    """A large dictionary: distinct whitespace tokens of ``benchmark.text``.

    The token keeps its case; it is cleaned like a dictionary line (F5) and
    typed by ``length % 5``.
    """
    toks = (
        bench.select(F.explode(whitespace_split("text")).alias("tok"))
        .where(F.col("tok") != "")
        .distinct()
    )
    name = java_trim("tok")
    types = F.array(*[F.lit(t) for t in BENCHMARK_TYPES])
    return (
        toks.select(name.alias("entity_name"))
        .where((F.col("entity_name") != "") & ~F.col("entity_name").startswith("#"))
        .select(
            F.element_at(types, (F.length("entity_name") % 5 + 1).cast("int")).alias("entity_type"),
            "entity_name",
        )
    )


def _marked(column: str, marks: int, values: dict[int, Column], otherwise: Column) -> Column:
    """A CASE on ``column % marks``."""
    out = otherwise
    for k, v in values.items():
        out = F.when(F.col(column) % marks == k, v).otherwise(out)
    return out


def document_lines(docs: DataFrame) -> DataFrame:
    """Every line of every document, ``(doc_id, line_no, lang, value)``, 1-based, and marked lines
    beside them.

    By ``doc_id``: the lines wrapped in a tab and a vertical tab, or given a supplementary
    character, or left alone and followed by a further line for each: empty, a comment, or blank
    (form feed and carriage return).
    """
    lines, mark = F.split("text", "\n"), F.col("doc_id") % LINE_MARKS
    whole = F.when(mark == 0, F.transform(lines, lambda v: F.concat(F.lit("\t"), v, F.lit("\v"))))
    whole = whole.when(mark == 3, F.transform(lines, lambda v: F.concat(v, F.lit(ASTRAL)))).otherwise(lines)
    further = F.when(mark == 1, F.transform(lines, lambda v: F.lit("")))
    further = further.when(mark == 2, F.transform(lines, lambda v: F.concat(F.lit(" # "), v)))
    further = further.when(mark == 5, F.transform(lines, lambda v: F.concat(F.lit("\t#"), v)))
    further = further.when(mark == 4, F.transform(lines, lambda v: F.lit("\f\r"))).otherwise(F.array().cast("array<string>"))
    return docs.select("doc_id", "lang", F.posexplode(F.concat(whole, further)).alias("pos", "value")).select(
        "doc_id", (F.col("pos") + 1).cast("bigint").alias("line_no"), "lang", "value"
    )


def spaced_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with spaces replaced, by ``doc_id``, by tab, VT, FF or CR."""
    swaps = {k: F.replace("text", F.lit(" "), F.lit(c)) for k, c in enumerate("\t\v\f\r", 1)}
    return docs.select("doc_id", _marked("doc_id", SPACE_MARKS, swaps, F.col("text")).alias("text"))


def astral_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with 0 to 2 supplementary characters at the end, by ``doc_id``."""
    return docs.select("doc_id", F.concat("text", F.repeat(F.lit(ASTRAL), (F.col("doc_id") % ASTRAL_MARKS).cast("int"))).alias("text"))


def with_blank_posts(posts: DataFrame) -> DataFrame:
    """All posts, and for every eleventh another one (``-1 - post_id``) with its title and a body
    of white space only."""
    blank = posts.where(F.col("post_id") % BLANK_BODY_EVERY == 0).select(
        (-1 - F.col("post_id")).alias("post_id"), "feed_name", "title", F.lit("\t \n").alias("selftext")
    )
    return posts.select("post_id", "feed_name", "title", "selftext").unionByName(blank)


def dictionary_lines_from_documents(docs: DataFrame) -> DataFrame:
    """Document lines as dictionary-file lines: ``(doc_id, line_no, file_name, value)``."""
    return document_lines(docs).select(
        "doc_id", "line_no", _lookup(LINE_FILE_BY_LANG, "lang").alias("file_name"), "value"
    )


def dictionary_files_from_documents(docs: DataFrame) -> DataFrame:
    """File names present in the document-derived dictionary directory.

    Every document has at least one line (``split`` never returns an empty
    array), so a file exists exactly when a document of its language does:
    no need to split the texts.
    """
    return docs.select(_lookup(LINE_FILE_BY_LANG, "lang").alias("file_name")).where(
        F.col("file_name").isNotNull()
    )


def requested_types_from_documents(docs: DataFrame) -> DataFrame:
    """Document lines with a caller-given type string per language."""
    return document_lines(docs).select(
        "doc_id", "line_no", _lookup(TYPE_BY_LANG, "lang").alias("requested_type"), "value"
    )


# ---------------------------------------------------------------- feeds ----

def feeds_from_documents(docs: DataFrame, page_size: int = FEED_PAGE_SIZE) -> DataFrame:
    """Landed-feed table ``(feed_id, feed_name, url, content)`` built from documents.

    A feed is one page of one source: posts with ``doc_id div page_size``
    equal, so no feed holds more than ``page_size`` posts however skewed the
    sources are. ``feed_id`` is the page's smallest ``doc_id``.
    """
    posts = documents_as_posts(docs).select(
        F.col("feed_name").alias("source"),
        "post_id",
        "title",
        "selftext",
        F.floor(F.col("post_id") / page_size).cast("bigint").alias("page"),
    )
    full = F.to_json(F.struct(F.struct("title", "selftext").alias("data")))
    # only the damaged source needs a title-only child
    title_only = F.when(
        F.col("source") == MISSING_FIELD_SOURCE, F.to_json(F.struct(F.struct("title").alias("data")))
    )
    child = F.struct("post_id", F.struct(full.alias("j"), title_only.alias("t")).alias("c"))
    grouped = posts.groupBy("source", "page").agg(
        F.min("post_id").alias("feed_id"),
        F.array_sort(F.collect_list(child)).alias("cs"),
    )
    children = F.transform(
        "cs",
        lambda x, i: F.when(
            (F.col("source") == MISSING_FIELD_SOURCE) & (i == 0), x["c"]["t"]
        ).otherwise(x["c"]["j"]),
    )
    body = F.concat(F.lit('{"data":{"children":['), F.array_join(children, ","), F.lit("]}}"))
    content = (
        F.when(F.col("source") == FAILED_SOURCE, F.lit(None).cast("string"))
        .when(F.col("source") == HTML_PAGE_SOURCE, F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")))
        .otherwise(body)
    )
    return grouped.select(
        "feed_id",
        F.concat_ws("/", "source", F.col("page").cast("string")).alias("feed_name"),
        F.format_string("https://feeds.example/%s/page/%d.json", F.col("source"), F.col("page")).alias("url"),
        content.alias("content"),
    )


# -------------------------------------------------------- subscriptions ----

def subscription_entries_from_pages(pages: DataFrame) -> DataFrame:
    """One subscription entry per page, as JSON text: ``(entry_index, entry_json)``.

    Pages whose URL has a fragment (``#``) get no ``name`` key, so they are
    rejected by validation.
    """
    title = F.regexp_extract("html", r"<title>(.*?)</title>", 1)
    entry = F.when(
        F.instr("url", "#") > 0, F.create_map(F.lit("url"), F.col("url"))
    ).otherwise(F.create_map(F.lit("name"), title, F.lit("url"), F.col("url")))
    return pages.select(F.col("page_id").alias("entry_index"), F.to_json(entry).alias("entry_json"))


# ------------------------------------------------------ files on storage ----
# The engine's file sources, fed with files that Spark writes from the tables.

def write_subscription_files(pages: DataFrame, path: str) -> str:
    """One array file for every ``SUBSCRIPTIONS_PER_FILE`` pages, under ``path/bucket=N``; of every
    four, the third holds its first entry bare and the fourth lacks its last bracket."""
    entries = subscription_entries_from_pages(pages).withColumn(
        "bucket", F.floor(F.col("entry_index") / SUBSCRIPTIONS_PER_FILE).cast("bigint")
    )
    grouped = entries.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("entry_index", "entry_json"))).alias("es"))
    texts = F.transform("es", lambda e: e["entry_json"])
    opened = F.concat(F.lit("["), F.array_join(texts, ","))
    body = F.when(F.col("bucket") % 4 == 2, texts[0]).when(F.col("bucket") % 4 == 3, opened).otherwise(F.concat(opened, F.lit("]")))
    grouped.select("bucket", body.alias("value")).write.partitionBy("bucket").text(path)
    return path


def write_dictionary_dir(docs: DataFrame, path: str) -> str:
    """Document lines as dictionary files: a folder of parts for each file name."""
    lines = dictionary_lines_from_documents(docs)
    for _, name in LINE_FILE_BY_LANG:
        lines.where(F.col("file_name") == name).select("value").write.text(f"{path}/{name}")
    return path


def feed_file_writer(folder: str):
    """One partition's feed bodies as files below ``folder``, a file for each feed; Arrow batches
    ``feed_id, feed_name, content`` in, ``feed_id, feed_name, url`` out. A file is named by its feed
    and appears whole, so a repeated attempt writes the same again."""

    def write(batches):
        import hashlib
        import os
        import uuid
        from pathlib import Path

        import pyarrow as pa

        for batch in batches:
            urls = []
            for feed_id, name, content in zip(*(batch.column(k) for k in range(3)), strict=True):
                if not feed_id.is_valid:
                    urls.append(None)
                elif not content.is_valid:
                    urls.append(f"file:///missing/{feed_id.as_py()}")
                else:
                    key = hashlib.sha1(name.as_py().encode()).hexdigest()
                    file = Path(folder, key[:FEED_FOLDER_DIGITS], f"{feed_id.as_py()}-{key}.json")
                    file.parent.mkdir(parents=True, exist_ok=True)
                    part = file.with_name(f".{file.name}-{uuid.uuid4().hex}")
                    with open(part, "wb") as out:
                        out.write(content.as_buffer())
                        out.write(b"\n")
                    os.replace(part, file)
                    urls.append(file.as_uri())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(urls, pa.string())], names=["feed_id", "feed_name", "url"])

    return write


def write_feed_files(docs: DataFrame, path: str) -> DataFrame:
    """Feed bodies as files below ``path``; the subscriptions (landed beside them) that point at
    them with ``file:`` urls. Feeds without a body point at a file that does not exist, feeds
    without an id nowhere. The fetcher opens local files only, so ``path`` has to be on a file
    system of that kind.

    The tasks that make the bodies write them and tell where: a feed costs one file, and neither
    commits nor listings of all feeds pass through the driver."""
    spark = docs.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    if scheme != "file":
        raise RuntimeError(f"the fetcher cannot open {scheme}: urls; point spark.checkpoint.dir at a file: path for this query")
    feeds = feeds_from_documents(docs).select("feed_id", "feed_name", "content")
    written = feeds.mapInArrow(feed_file_writer(f"{hadoop.toUri().getPath()}/feeds"), FEED_URLS)
    written.write.parquet(f"{path}/feed-urls")
    return spark.read.schema(FEED_URLS).parquet(f"{path}/feed-urls")


def write_run_inputs(docs: DataFrame, pages: DataFrame, bench: DataFrame, path: str) -> tuple[str, str]:
    """Everything a whole run reads, as files below ``path``: subscription array files (an entry
    for every document feed, with its ``file:`` url, and a nameless one for every page whose url
    has a ``#``) and a dictionary directory (``benchmark`` tokens by type). Returns both paths."""
    feeds = write_feed_files(docs, path)
    per_file = FEED_PAGE_SIZE * SUBSCRIPTIONS_PER_FILE
    bucket = lambda c: F.floor(F.col(c) / per_file).cast("bigint").alias("bucket")
    entry = F.to_json(F.struct(F.col("feed_name").alias("name"), "url"))
    nameless = pages.where(F.instr("url", "#") > 0).select(bucket("page_id"), F.lit(1).alias("kind"), F.col("page_id").alias("id"), F.to_json(F.struct("url")).alias("entry"))
    entries = feeds.select(bucket("feed_id"), F.lit(0).alias("kind"), F.col("feed_id").alias("id"), entry.alias("entry")).unionByName(nameless)
    grouped = entries.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("kind", "id", "entry"))).alias("es"))
    body = F.concat(F.lit("["), F.array_join(F.transform("es", lambda e: e["entry"]), ",\n"), F.lit("]"))
    grouped.select("bucket", body.alias("value")).write.partitionBy("bucket").text(f"{path}/subscriptions")
    dictionary = benchmark_dictionary(bench)
    for name, kind in DICTIONARY_FILES:
        dictionary.where(F.col("entity_type") == kind).select(F.col("entity_name").alias("value")).write.text(f"{path}/entities/{name}")
    return f"{path}/subscriptions", f"{path}/entities"
