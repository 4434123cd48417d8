"""Dictionary sources: files, cleaning, typing.

The directory is read in one scan (``spark.read.text`` with the file name
from ``_metadata``), each line is cleaned like ``trim / nonEmpty /
not startsWith("#")``, and the file name is joined to the fixed file map to
give the type. Other files in the directory are ignored; a missing file
simply contributes nothing. The result is a bag: duplicates are kept, and
they count double downstream, as in the reference.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.text import java_trim
from feedlens.schemas import ENTITY_TYPES, FALLBACK_ENTITY_TYPE, dictionary_file_map, literal_table


class DictionaryDirNotFound(FileNotFoundError):
    """Q4: the entities directory does not exist."""


def _not_found(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e)


def require_dictionary_dir(spark: SparkSession, entities_dir: str) -> None:
    """Q4: raise when the directory does not exist (an empty one is fine).

    A recursive listing has no partition discovery, so subdirectories of
    any shape cannot make this check fail.
    """
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.txt"
        ).load(entities_dir)
    except AnalysisException as e:
        if _not_found(e):
            raise DictionaryDirNotFound(f"entities directory '{entities_dir}' not found") from e
        raise


def _top_level(entities_dir: str) -> str:
    # entries directly in the directory, as the reference reads them; a large
    # dictionary file may be a folder of parts of the same name. Other
    # subdirectories are ignored
    return entities_dir.rstrip("/") + "/*.txt"


def _file_name(path: Column, entities_dir: str) -> Column:
    """The name directly below ``entities_dir`` on ``path``."""
    folder = entities_dir.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_extract(path, rf"/\Q{folder}\E/([^/]+\.txt)(?:/[^/]+)?$", 1)


def read_dictionary_lines(spark: SparkSession, entities_dir: str) -> DataFrame:
    """S4 + S5: ``(file_name, value)`` for every line of every top-level ``*.txt`` file."""
    require_dictionary_dir(spark, entities_dir)
    try:
        lines = spark.read.text(_top_level(entities_dir))
    except AnalysisException as e:
        if _not_found(e):  # the directory exists but holds no .txt file
            return literal_table(spark, [], "file_name string, value string")
        raise
    return lines.select(_file_name(F.col("_metadata.file_path"), entities_dir).alias("file_name"), "value")


def clean_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """``entity_name = trim(value)``; drop empty and ``#`` comment lines."""
    name = java_trim(F.col(value))
    return (
        lines.withColumn("entity_name", name)
        .where((F.col("entity_name") != "") & ~F.col("entity_name").startswith("#"))
    )


def type_by_file(lines: DataFrame, files: list[tuple[str, str]] | None = None) -> DataFrame:
    """P3 for the dictionary files + U1: inner join with the file map.

    The map is a literal of a few rows (five by default; D6: pass more
    ``(file_name, entity_type)`` pairs to add a type), so broadcasting it is
    bounded.
    """
    fmap = F.broadcast(dictionary_file_map(lines.sparkSession, files))
    return lines.join(fmap, "file_name")


def load_dictionary(spark: SparkSession, entities_dir: str, files: list[tuple[str, str]] | None = None) -> DataFrame:
    """The whole dictionary, ``(entity_type, entity_name)``, duplicates kept."""
    return type_by_file(clean_lines(read_dictionary_lines(spark, entities_dir)), files).select(
        "entity_type", "entity_name"
    )


def with_fallback_type(requested: Column | str, types: list[str] | None = None) -> Column:
    """P3 for a caller-given type: a known type (the six by default), else Person."""
    r = F.col(requested) if isinstance(requested, str) else requested
    return F.when(r.isin(*(ENTITY_TYPES if types is None else types)), r).otherwise(F.lit(FALLBACK_ENTITY_TYPE))


def load_dictionary_file(spark: SparkSession, path: str, entity_type: str) -> DataFrame:
    """One file with a caller-given type (unknown types fall back to Person).

    A missing file contributes nothing (S6), like a missing file in a directory.
    """
    try:
        raw = spark.read.text(path)
    except AnalysisException as e:
        if _not_found(e):
            return literal_table(spark, [], "entity_type string, entity_name string")
        raise
    lines = clean_lines(raw)
    return lines.select(with_fallback_type(F.lit(entity_type)).alias("entity_type"), "entity_name")


def present_dictionary_files(spark: SparkSession, entities_dir: str) -> DataFrame:
    """Top-level ``*.txt`` file names in the directory, empty files included.

    ``binaryFile`` lists files; with only ``path`` selected their content is
    not read.
    """
    require_dictionary_dir(spark, entities_dir)
    try:
        listing = spark.read.format("binaryFile").load(_top_level(entities_dir))
    except AnalysisException as e:
        if _not_found(e):
            return literal_table(spark, [], "file_name string")
        raise
    return listing.select(_file_name(F.col("path"), entities_dir).alias("file_name")).distinct()


def missing_dictionary_files(present: DataFrame, files: list[tuple[str, str]] | None = None) -> DataFrame:
    """Expected files not present, in load order (the run continues)."""
    fmap = dictionary_file_map(present.sparkSession, files)
    return fmap.join(present.select("file_name").distinct(), "file_name", "left_anti").select(
        "file_order", "file_name", "entity_type"
    )
