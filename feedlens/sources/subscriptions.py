"""Subscriptions source (S1) and entry validation.

A subscriptions file is one JSON array of string maps. Any parse error, a
top-level value that is not an array, or an element that is not a string map
makes the whole file invalid (Q2). Inside a valid file, an entry without
both ``name`` and ``url`` is rejected with a warning row (Q6) and the rest
is kept. Extra keys are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.jsonfeed import UNLIMITED, plain

ENTRY_TYPE = "map<string,string>"


class SubscriptionsNotFound(FileNotFoundError):
    """Q1: the subscriptions file does not exist."""


class InvalidSubscriptionsFile(ValueError):
    """Q2: the subscriptions file is not a JSON array of string maps."""


class NoValidSubscriptions(ValueError):
    """Q3: no entry has both a name and a url."""


def _strict(entry: Column, text: Column) -> Column:
    """``entry`` unless a value is an object or array. ``from_json`` gives those as their text,
    so only an entry with a value that begins with a bracket is looked at again."""
    doubtful = F.exists(F.map_values(entry), lambda v: F.coalesce(~plain(v) & v.isNotNull(), F.lit(False)))
    values = F.map_values(F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>"))
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
    scalars = F.forall(values, lambda v: ~kind(v).startswith("OBJECT") & ~kind(v).startswith("ARRAY"))
    return F.when(~doubtful | F.coalesce(scalars, F.lit(False)), entry)


def parse_entry_array(text: Column) -> Column:
    """N1 + N5: ``array<map<string,string>>``; NULL when the text is not an array of maps, an
    entry that does not fit is NULL. A key given twice counts once, with its last value."""
    entries = F.from_json(text, f"array<{ENTRY_TYPE}>", UNLIMITED)
    texts = F.from_json(text, "array<string>", UNLIMITED)
    return F.zip_with(entries, texts, _strict)


def parse_entry(text: Column) -> Column:
    """One entry given as its own JSON object text."""
    return _strict(F.from_json(text, ENTRY_TYPE, UNLIMITED), text)


def read_subscription_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file under ``path``: ``file, entries, file_ok``.

    ``wholetext`` keeps a file in one row: the format is a single JSON
    array, so a file is the unit of validity.
    """
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SubscriptionsNotFound(f"Could not load {path} - file not found") from e
        raise
    arr = parse_entry_array(F.col("value"))
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        arr.alias("entries"),
        F.coalesce(arr.isNotNull() & F.forall(arr, lambda e: e.isNotNull()), F.lit(False)).alias("file_ok"),
    )


def entry_valid(e: Column) -> Column:
    """F3 rule on one entry map: both ``name`` and ``url`` present and not null."""
    return F.try_element_at(e, F.lit("name")).isNotNull() & F.try_element_at(e, F.lit("url")).isNotNull()


def validate_entries(entries: DataFrame, entry: str = "entry") -> DataFrame:
    """add ``name``, ``url``, ``is_valid`` to a DataFrame with a map column.

    A key present with JSON null counts as missing.
    """
    e = F.col(entry)
    return (
        entries.withColumn("name", F.try_element_at(e, F.lit("name")))
        .withColumn("url", F.try_element_at(e, F.lit("url")))
        .withColumn("is_valid", entry_valid(e))
    )


def valid_subscriptions(validated: DataFrame) -> DataFrame:
    """the kept side of F3."""
    return validated.where("is_valid")


def rejected_subscriptions(validated: DataFrame) -> DataFrame:
    """Q6: the rejected side of F3 (one warning row each)."""
    return validated.where(~F.col("is_valid"))


@dataclass(frozen=True)
class Subscriptions:
    files: DataFrame
    validated: DataFrame
    n_valid: int | None = None  # known when the file check ran

    @property
    def valid(self) -> DataFrame:
        return valid_subscriptions(self.validated).select(
            "feed_id", F.col("name").alias("feed_name"), "url"
        )

    @property
    def rejected(self) -> DataFrame:
        return rejected_subscriptions(self.validated)


def file_entries(files: DataFrame) -> DataFrame:
    """F3 on the entries of the valid files, keyed by ``feed_id``."""
    entries = files.where("file_ok").select("file", F.posexplode("entries").alias("entry_index", "entry"))
    return validate_entries(entries.withColumn("feed_id", F.xxhash64("file", "entry_index")))


def read_subscriptions(spark: SparkSession, path: str, check: bool = True) -> Subscriptions:
    """Read, check the file (Q1, Q2) and validate entries.

    ``feed_id`` is a hash of the file and the entry's position in it, so it
    is unique over any number of files and stable on retry. The check runs
    one tiny aggregate on the file rows.
    """
    files = read_subscription_files(spark, path)
    n_valid = None
    if check:
        # Q2 and the number of valid entries (for Q3) in one small aggregate
        valid_in_file = F.size(F.filter("entries", entry_valid))
        row = files.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(~F.col("file_ok")).alias("bad"),
            F.coalesce(F.sum(F.when(F.col("file_ok"), valid_in_file)), F.lit(0)).alias("valid"),
        ).first()
        if row["n"] == 0 or row["bad"] > 0:
            raise InvalidSubscriptionsFile(f"Could not load {path} - invalid JSON format")
        n_valid = int(row["valid"])
    return Subscriptions(files, file_entries(files), n_valid)


def require_valid(subs: Subscriptions) -> DataFrame:
    """Q3: raise when no entry is valid; return the valid ones."""
    valid = subs.valid
    empty = subs.n_valid == 0 if subs.n_valid is not None else valid.isEmpty()
    if empty:
        raise NoValidSubscriptions("No valid subscriptions found")
    return valid


def read_subscription_lines(spark: SparkSession, path: str, check: bool = True) -> Subscriptions:
    """Scale variant of S1: one JSON object per line (JSON Lines).

    Lines are split across tasks, so a list of millions of subscriptions is
    parsed in parallel. A non-empty line that is not a JSON object of strings
    makes the input invalid (Q2), like a bad element of an array file.
    ``feed_id`` is a hash of (file, line text): stable on retry. A line listed
    twice keeps two rows (fetched and counted twice) that share the id.
    """
    try:
        raw = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise SubscriptionsNotFound(f"Could not load {path} - file not found") from e
        raise
    lines = raw.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file"),
        parse_entry(F.col("value")).alias("entry"),
        F.col("value"),
    )
    if check:
        bad = lines.where(F.col("entry").isNull()).limit(1).count()
        if bad:
            raise InvalidSubscriptionsFile(f"Could not load {path} - invalid JSON format")
    entries = lines.select(
        "file", F.xxhash64("file", "value").alias("feed_id"), F.lit(None).cast("int").alias("entry_index"), "entry"
    )
    files = lines.groupBy("file").agg(F.count_if(F.col("entry").isNull()).alias("bad")).select(
        "file", F.lit(None).cast(f"array<{ENTRY_TYPE}>").alias("entries"), (F.col("bad") == 0).alias("file_ok")
    )
    return Subscriptions(files, validate_entries(entries))
