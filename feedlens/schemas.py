"""Data model: schemas and the entity-type dimension.

The reference models entity types as a class hierarchy; here a type is a row
of a small dimension table, and extending the engine with a new type means
adding a row here and, if it has a dictionary file, a row to the file map.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: must equal the reference for identical output. ---------
# Entity types in report order (the type-statistics report lists them so).
ENTITY_TYPES = ["Person", "Organization", "University", "Place", "Technology", "ProgrammingLanguage"]
# Dictionary files read from the entities directory, in load order, with the
# type given to every entry of the file. There is no file for Technology.
DICTIONARY_FILES = [
    ("people.txt", "Person"),
    ("universities.txt", "University"),
    ("languages.txt", "ProgrammingLanguage"),
    ("organizations.txt", "Organization"),
    ("places.txt", "Place"),
]
# A caller-given type outside ENTITY_TYPES falls back to this one.
FALLBACK_ENTITY_TYPE = "Person"
# Label of the all-types row in type statistics.
TOTAL_LABEL = "total"
# --- end of fixed values ----------------------------------------------------

SUBSCRIPTION = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]
)

FEED = T.StructType(
    [
        T.StructField("feed_id", T.LongType()),
        T.StructField("feed_name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

POST = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("feed_name", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
    ]
)

DICTIONARY = T.StructType(
    [T.StructField("entity_type", T.StringType()), T.StructField("entity_name", T.StringType())]
)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table built in the JVM (no Python worker, no RDD).

    ``schema`` is a DDL string such as ``"ordinal int, entity_type string"``.
    Used only for the handful of fixed rows of this module and for literal
    test dictionaries.
    """
    fields = [f.strip().split() for f in schema.split(",")]
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])
    if all(_plain(v) for r in rows for v in r):
        # one SQL expression: one round trip to the JVM instead of one per value
        structs = ", ".join(
            "named_struct(" + ", ".join(f"'{n}', CAST({_sql_literal(v)} AS {t})" for v, (n, t) in zip(r, fields)) + ")"
            for r in rows
        )
        return spark.range(1).selectExpr(f"inline(array({structs}))")
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, fields)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def _plain(v) -> bool:
    """A value whose SQL literal needs no escaping (so parser settings cannot matter)."""
    if v is None or isinstance(v, (bool, int, float)):
        return True
    return isinstance(v, str) and all(" " <= c and c not in "'\\" for c in v)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return f"'{v}'"


def entity_types(spark: SparkSession, types: list[str] | None = None) -> DataFrame:
    """The entity types with their report ordinal (1-based)."""
    types = ENTITY_TYPES if types is None else types
    return literal_table(spark, [(i + 1, t) for i, t in enumerate(types)], "ordinal int, entity_type string")


def dictionary_file_map(spark: SparkSession, files: list[tuple[str, str]] | None = None) -> DataFrame:
    """``(file_order, file_name, entity_type)``; extend by passing more pairs."""
    files = DICTIONARY_FILES if files is None else files
    return literal_table(
        spark,
        [(i + 1, f, t) for i, (f, t) in enumerate(files)],
        "file_order int, file_name string, entity_type string",
    )
