"""Whole-word, case-insensitive dictionary matching (J1) and its plans.

A post field is reduced to its set of lowercase whitespace tokens (U3), the
two fields are searched apart (U2), and every dictionary row whose lowercase
name equals a token is a hit (F6, P4). That is an inner equi-join on
``token = lower(entity_name)``, so it runs as a hash join instead of the
reference's per-post loop over the dictionary.

Two physical plans:

* **broadcast** (D1): the dictionary, after a size check, is broadcast; tokens
  never shuffle, and only per-task partial counts by (type, name) do.
* **aggregate-first**: for a dictionary too large to broadcast, tokens are
  counted per word first (partial aggregation combines hot words such as
  "the" map-side, so they cannot skew the shuffle), and only the vocabulary
  meets the dictionary in a shuffle join.

Both give the same counts; tests check that. Per-post hits cannot be
pre-aggregated. For an over-bound dictionary a Bloom filter of its keys is
broadcast (``operators.keyfilter``) and drops, where the corpus is read, the
tokens that cannot match. The rest is landed, so the corpus is read once;
the dictionary is cut to the words that are left and measured again. If it
fits now the join is broadcast; otherwise it is a sort-merge join with hot
words split by a salt (``salted_join``). Only a dictionary whose filter is
over its own bound has the corpus read twice (``restrict_to_corpus``).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens import config
from feedlens.functions.text import java_lower, word_set
from feedlens.operators import keyfilter
from feedlens.schemas import literal_table
from feedlens.sources.feeds import land

POST_FIELDS = ("title", "selftext")


@dataclass(frozen=True)
class PreparedDictionary:
    """A dictionary with its match key and a checked size.

    ``df`` columns: ``entity_type, entity_name, key`` with ``key =
    lower(entity_name)``; rows are a bag (duplicates kept). ``broadcast`` is
    True only when the measured size is within the configured bounds.
    """

    df: DataFrame
    rows: int
    approx_bytes: int
    broadcast: bool
    weighted_df: DataFrame | None = None
    pinned: str | None = None
    vocabulary: DataFrame | None = None  # landed (word, word_n) of the corpus it was cut to

    def weighted(self) -> DataFrame:
        """One row per distinct entry with its multiplicity ``mult``.

        ``key`` is a function of ``entity_name``, so grouping by (key, type,
        name) is grouping by (type, name); partial aggregation folds
        duplicated entries map-side.
        """
        if self.weighted_df is not None:
            return self.weighted_df
        return self.df.groupBy("key", "entity_type", "entity_name").agg(
            F.count(F.lit(1)).alias("mult")
        )


def keyed_dictionary(dictionary: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Add the match key; drop entries no token can equal.

    A token is non-empty and holds no whitespace, so names whose lowercase
    form is empty or contains whitespace (e.g. multi-word places) never
    match; dropping them here only shrinks the join.
    """
    # The predicates are on entity_name, not on key: a predicate on key would be
    # inferred onto the token side through ``word = key`` and run per token.
    key = java_lower("entity_name")
    return dictionary.where(
        (F.col("entity_name") != "") & ~F.col("entity_name").rlike(config.WHITESPACE_RE)
    ).select("entity_type", "entity_name", *extra, key.alias("key"))


def _measure(keyed: DataFrame, max_rows: int, max_bytes: int, force: str | None) -> PreparedDictionary:
    row = keyed.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(
            F.sum(F.octet_length("entity_type") + 2 * F.octet_length("entity_name") + config.BROADCAST_ROW_OVERHEAD), F.lit(0)
        ).alias("b"),
    ).first()
    rows, nbytes = int(row["n"]), int(row["b"])
    fits = rows <= max_rows and nbytes <= max_bytes
    if force == "broadcast" and not fits:
        raise ValueError(f"dictionary of {rows} rows / {nbytes} bytes is too large to broadcast")
    return PreparedDictionary(keyed, rows, nbytes, fits and force != "shuffle", pinned=force)


def prepare_dictionary(
    dictionary: DataFrame,
    max_rows: int = config.MAX_BROADCAST_DICTIONARY_ROWS,
    max_bytes: int = config.MAX_BROADCAST_DICTIONARY_BYTES,
    force: str | None = None,
) -> PreparedDictionary:
    """Measure the dictionary (one small aggregate job) and choose the plan.

    ``force`` may be ``"broadcast"`` or ``"shuffle"`` to pin the plan (tests,
    benchmarks); a forced broadcast still has to pass the size check.
    """
    return _measure(keyed_dictionary(dictionary), max_rows, max_bytes, force)


def restrict_to_corpus(
    posts: DataFrame,
    dictionary: PreparedDictionary,
    fields: tuple[str, ...] = ("title", "selftext"),
    max_rows: int = config.MAX_BROADCAST_DICTIONARY_ROWS,
    max_bytes: int = config.MAX_BROADCAST_DICTIONARY_BYTES,
) -> PreparedDictionary:
    """Keep only entries whose key occurs as a token somewhere in ``posts``.

    Exact: an entry whose key never occurs cannot produce a hit. The
    vocabulary is built with map-side partial aggregation (hot words fold
    before the shuffle), so this pass moves distinct words, not tokens. Both
    the vocabulary and the cut dictionary are landed: the corpus is read
    once here, and measuring and joining read the landed tables. When the
    cut dictionary fits, per-post hits use a broadcast join and tokens never
    cross the network.
    """
    return _cut_to(field_words(posts, keys=(), fields=fields), dictionary, max_rows, max_bytes)


def _cut_to(words: DataFrame, dictionary: PreparedDictionary, max_rows: int, max_bytes: int) -> PreparedDictionary:
    """``dictionary`` cut to the entries whose key is one of ``words``, with their landed counts."""
    vocab = land(words.groupBy("word").agg(F.count(F.lit(1)).alias("word_n")), "vocabulary")
    matched = land(dictionary.df.join(vocab.hint("merge"), dictionary.df["key"] == vocab["word"], "left_semi"), "dictionary")
    return replace(_measure(matched, max_rows, max_bytes, dictionary.pinned), vocabulary=vocab)


def candidate_words(
    posts: DataFrame,
    dictionary: PreparedDictionary,
    keys: tuple[str, ...],
    fields: tuple[str, ...] = ("title", "selftext"),
) -> DataFrame:
    """The tokens that may match, landed: one pass over the corpus, in which the broadcast
    filter of the dictionary's keys drops all others before anything moves."""
    filtered = keyfilter.build(dictionary.df, "key", dictionary.rows)
    return land(keyfilter.passing(field_words(posts, keys, fields), "word", filtered), "candidate-words")


def salted_join(words: DataFrame, dictionary: PreparedDictionary, keys: tuple[str, ...]) -> DataFrame:
    """``words`` joined to a dictionary too large to broadcast, hot words split.

    The landed vocabulary tells which words hold over 1/``HOT_SHARE`` of all
    tokens: at most ``HOT_SHARE`` of them, so their list is broadcast. A hot
    word without an entry is dropped where it is read; the rows of one with
    an entry get a salt, and its entries are repeated for each salt. The
    rest is an ordinary sort-merge join, which can spill on either side.
    """
    vocab = dictionary.vocabulary
    total = vocab.agg(F.sum("word_n").alias("n")).first()["n"] or 0
    parts = F.ceil(F.col("word_n") * config.HOT_SHARE / F.lit(max(total, 1))).cast("int")
    hot = vocab.where(F.col("word_n") * config.HOT_SHARE > total).select(F.col("word").alias("hot_word"), parts.alias("parts"))
    entries = dictionary.df.select(F.col("key").alias("hot_word"), F.lit(True).alias("listed")).distinct()
    hot = land(hot.join(entries, "hot_word", "left"), "hot-words")
    marked = words.join(F.broadcast(hot), words["word"] == hot["hot_word"], "left").where("hot_word is null or listed")
    salt = F.pmod(F.xxhash64(*keys, "field"), F.coalesce("parts", F.lit(1)))
    salted = marked.withColumn("salt", salt.cast("int")).drop("hot_word", "parts", "listed")
    split = dictionary.df.join(F.broadcast(hot.select("hot_word", "parts")), dictionary.df["key"] == hot["hot_word"], "left")
    repeated = split.withColumn("entry_salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("hot_word", "parts")
    return salted.join(repeated.hint("merge"), (F.col("word") == F.col("key")) & (F.col("salt") == F.col("entry_salt")))


def prepare_literal_dictionary(spark, rows: list[tuple[str, str]]) -> PreparedDictionary:
    """A dictionary given as rows on the driver: its size is known without a job."""
    usable = [(t, n) for t, n in rows if n and not any(c in n for c in " \t\n\x0b\f\r")]
    nbytes = sum(len(t.encode()) + 2 * len(n.encode()) + config.BROADCAST_ROW_OVERHEAD for t, n in usable)
    fits = len(usable) <= config.MAX_BROADCAST_DICTIONARY_ROWS and nbytes <= config.MAX_BROADCAST_DICTIONARY_BYTES
    df = keyed_dictionary(literal_table(spark, rows, "entity_type string, entity_name string"))
    # multiplicities of the (type, name) rows are counted here, where the rows
    # are; the key is still lowered by Spark (JVM case rules)
    counted = [(t, n, c) for (t, n), c in Counter(rows).items()]
    weighted = keyed_dictionary(
        literal_table(spark, counted, "entity_type string, entity_name string, mult bigint"), extra=("mult",)
    )
    return PreparedDictionary(df, len(usable), nbytes, fits, weighted)


def field_words(
    posts: DataFrame,
    keys: tuple[str, ...] = ("post_id",),
    fields: tuple[str, ...] = POST_FIELDS,
) -> DataFrame:
    """U2 + U3: one row per (post, field, distinct non-empty lowercase token).

    Rows stay in the input's partitions; a caller whose files hold few row
    groups spreads the posts before (``repartition`` on the post key).
    """
    arr = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])
    return (
        posts.select(*keys, F.inline(arr))
        .select(*keys, "field", F.explode(word_set("text")).alias("word"))
        .where(F.col("word") != "")
    )


def _dictionary_side(dictionary: PreparedDictionary, df: DataFrame) -> DataFrame:
    """Broadcast when the size check passed; otherwise a sort-merge join, which can spill.

    The hint keeps Catalyst from broadcasting on a file-size estimate that
    the measured size already refuted.
    """
    return F.broadcast(df) if dictionary.broadcast else df.hint("merge")


def entity_hits(
    posts: DataFrame,
    dictionary: PreparedDictionary,
    keys: tuple[str, ...] = ("post_id",),
    fields: tuple[str, ...] = POST_FIELDS,
) -> DataFrame:
    """One row per (post, field, matching dictionary row); bag semantics.

    With a broadcast dictionary this is a BroadcastHashJoin and no token
    leaves its task. For a dictionary over the bound the tokens that may
    match are landed (``candidate_words``) and the dictionary is cut to them;
    if that fits, the join is broadcast, otherwise it is ``salted_join``.
    """
    if dictionary.broadcast:
        words = field_words(posts, keys, fields)
    elif keyfilter.fits(dictionary.rows):
        words = candidate_words(posts, dictionary, keys, fields)
        dictionary = _cut_to(words, dictionary, config.MAX_BROADCAST_DICTIONARY_ROWS, config.MAX_BROADCAST_DICTIONARY_BYTES)
    else:
        dictionary = restrict_to_corpus(posts, dictionary, fields)
        words = field_words(posts, keys, fields)
    if dictionary.broadcast:
        joined = words.join(F.broadcast(dictionary.df), words["word"] == dictionary.df["key"])
    else:
        joined = salted_join(words, dictionary, keys)
    return joined.select(*keys, "field", "entity_type", "entity_name")


def entity_counts_broadcast(posts: DataFrame, dictionary: PreparedDictionary) -> DataFrame:
    """Counts via the broadcast plan, weighting duplicate dictionary rows."""
    words = field_words(posts, keys=())
    d = F.broadcast(dictionary.weighted())
    return (
        words.join(d, words["word"] == d["key"])
        .groupBy("entity_type", "entity_name")
        .agg(F.sum("mult").cast("bigint").alias("n"))
    )


def entity_counts_aggregate_first(posts: DataFrame, dictionary: PreparedDictionary) -> DataFrame:
    """Counts by counting words first, then joining the vocabulary.

    ``count(post, field, word)`` summed over dictionary rows equals the hit
    count. After the word aggregation each word is one row, and each
    (type, name) has one key, so the join output is already one row per
    (type, name): no further shuffle.
    """
    words = field_words(posts, keys=())
    word_counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("word_n"))
    d = _dictionary_side(dictionary, dictionary.weighted())
    return word_counts.join(d, word_counts["word"] == d["key"]).select(
        "entity_type", "entity_name", (F.col("word_n") * F.col("mult")).cast("bigint").alias("n")
    )


def entity_counts(posts: DataFrame, dictionary: PreparedDictionary, plan: str = "auto") -> DataFrame:
    """A1 over posts: ``(entity_type, entity_name, n)`` for every matched entry.

    ``plan``: ``auto`` (broadcast when the size check passed, otherwise
    aggregate-first), ``broadcast`` or ``aggregate_first``.
    """
    if plan == "auto":
        plan = "broadcast" if dictionary.broadcast else "aggregate_first"
    if plan == "broadcast":
        if not dictionary.broadcast:
            raise ValueError("dictionary did not pass the broadcast size check")
        return entity_counts_broadcast(posts, dictionary)
    if plan == "aggregate_first":
        return entity_counts_aggregate_first(posts, dictionary)
    raise ValueError(f"unknown plan {plan!r}")
