"""From raw documents to packed training sequences, in five stages.

Each stage is one operator of ``feedlens.llm``; its input is what the stage before has kept,
written as Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from feedlens.llm.common import land

#: The tokenizer of the packed sequences (a file of ``public_tokenizers``) and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go. Null and empty texts go (too few words); very
    long texts are judged whole; repeated rows and rows without an id are judged alone; no rows
    give no rows; all columns stay as they are, whatever their names."""
    return quality_rules.keep_good(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays, one without an id only if none has
    one; of rows equal in id and text one stays; null and empty texts are equal; no rows give no
    rows; all columns stay as they are, whatever their names."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays. Null, empty and
    blank texts are linked with nothing and stay, and so do rows without an id; rows that repeat an
    id are one document and stay or go together; no rows give no rows; all columns stay as they
    are, whatever their names."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, at most three times. A document without words
    takes none of the mix's words (it stays as often as its source's documents do for certain); a null source is a source of its own, the last; ties in the
    draw go by id and text; no rows give no rows; all columns stay as they are, whatever their
    names."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document: its place in the packed sequences. Null and empty texts
    are the end id alone; very long texts are cut into whole pieces; repeated rows are packed each;
    no rows give no pieces."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack),
]

#: Near duplicates, the mix and the packing have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
