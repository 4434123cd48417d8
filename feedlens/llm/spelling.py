"""Spelling variants: words one edit apart, found by walking a trie relationally.

1. ``spelled_words`` counts the runs of letters of all texts (with the seeded misspellings of
   ``MISSPELL_EVERY``) in Python tasks that hand on partial counts; Spark adds them up and
   keeps the words of at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences.
2. All words make two tries, one of the words and one of the words reversed. A node is the
   64-bit hash of its prefix, so the tries are one distributed table of edges
   ``(node, label, child)``.
3. The frontier holds states (word, node, edits, way left to go). An edit lies in the second
   half of a word or of its reversal, so a word starts on its own path at every position from
   the middle on, with no edit made. The first level makes the edit: a deletion needs no
   edge, a replacement takes an edge of another letter, an insertion any edge. Every further
   level takes the edge of the next letter of the word; a state that finds none ends.
4. A state with nothing left to go stands on the last node of a near word.

A word of any length ends after few levels: with r code points to go an edge carries one of
them unless 8 divides r, else 8, unless 64 divides r, and so on. Both words of a state have
the same r, so they use the same edges. Hashes can only bring false states: every pair found
is confirmed with the edit distance of the two words.

A node may be shared by any share of the words: states of a node with over 1/``HOT_SHARE`` of
them are spread by a salt and its edges repeated for each (``spread_join``); such nodes are at
most ``HOT_SHARE`` many, which bounds their broadcast. Each level is landed.

Defined cases: null and empty texts have no words; a null id is written as nothing before the
colon; very long runs are words like others; rows repeated count each time; of near words with
the same count the first in code-point order is the form; an empty table gives no rows;
further columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, land, mix, slices, texts_of

#: Words have at least so many code points and occurrences.
MIN_LENGTH, MIN_COUNT = 6, 5
#: A run whose crc32 (with its document's id) is a multiple of this loses one code point.
MISSPELL_EVERY = 199
#: A word's form occurs at least so many times as often.
FORM_RATIO = 5
#: Code points on an edge: powers of this.
WIDTH = 8
#: Words of a task's dictionary before it hands its counts on.
HELD_WORDS = 400_000
#: A node with over 1/HOT_SHARE of the states (and over HOT_LEAST) is hot.
HOT_SHARE, HOT_LEAST = 2000, 5000

# Runs of A-Z, a-z and U+00C0 to U+00FF in lower-cased UTF-8: the latter are C3 80 to C3 BF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % MIN_LENGTH)
LEAD = 0xC3

BASE = 0x9E3779B97F4A7C15  # odd: has an inverse modulo 2**64
EDGE_SCHEMA = "node bigint, label bigint, child bigint, single boolean"
STATE_SCHEMA = "id bigint, node bigint, own bigint, prev bigint, here array<bigint>, next array<bigint>"
END_SCHEMA = "node bigint, id bigint"


def misspelled(run: bytes, crc: int) -> bytes:
    """``run`` without one code point, if its crc says so."""
    if crc % MISSPELL_EVERY:
        return run
    text = run.decode("utf-8")
    at = crc % len(text)
    return (text[:at] + text[at + 1 :]).encode("utf-8")


def count_runs(batches, id_at: int = 0):
    """Partial counts ``word, n`` of a partition's texts."""
    import pyarrow as pa

    held: Counter[bytes] = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()).cast(pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for part in slices(batch):
            for doc_id, raw in zip(part.column(id_at).to_pylist(), texts_of(part), strict=True):
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(RUN.findall(raw.lower())).items():
                    word = misspelled(run, zlib.crc32(run, before))
                    if len(word) - word.count(LEAD) >= MIN_LENGTH:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield out()
                held.clear()
    yield out()


def spelled_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, word, n``, landed: the words of all texts, with an id of their own."""
    runs = bounded_batches(df).selectExpr(f"cast(`{id_col}` as string) as id", f"`{text_col}` as text").mapInArrow(count_runs, "word string, n bigint")
    words = runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    return land(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelled-words")


def widths(left: np.ndarray) -> np.ndarray:
    """Code points on the edge with ``left`` code points to go."""
    out = np.ones(len(left), np.int64)
    while (wider := (left > 0) & (left % (out * WIDTH) == 0)).any():
        out[wider] *= WIDTH
    return out


class Paths:
    """Hashes of all prefixes and pieces of some words read in one direction."""

    def __init__(self, words: list[str], backwards: bool):
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.n = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.backwards = backwards
        if backwards and len(codes):
            word = np.repeat(np.arange(len(words)), self.n)
            codes = codes[2 * self.start[word] + self.n[word] - 1 - np.arange(len(codes))]
        self.codes = codes
        most = int(self.n.max(initial=0)) + 1
        self.power = np.full(most, BASE, np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power)
        self.inverse = np.full(most, pow(BASE, -1, 2**64), np.uint64)
        self.inverse[0] = 1
        self.inverse = np.cumprod(self.inverse)
        place = np.arange(len(codes)) - np.repeat(self.start, self.n)
        self.sums = np.r_[np.uint64(0), np.cumsum((codes + 1).astype(np.uint64) * self.power[place])]

    def nodes(self, word: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node after ``depth`` code points."""
        first = self.start[word]
        prefix = self.sums[first + depth] - self.sums[first]
        return mix(mix(prefix + np.uint64(1 + self.backwards)) + depth.astype(np.uint64)).view(np.int64)

    def labels(self, word: np.ndarray, at: np.ndarray, width: np.ndarray) -> np.ndarray:
        """A code point as it is; more of them as a negative hash."""
        first = self.start[word] + at
        piece = (self.sums[first + width] - self.sums[first]) * self.inverse[at]
        wide = mix(mix(piece) + width.astype(np.uint64)) | np.uint64(2**63)
        return np.where(width == 1, self.codes[first], wide.view(np.int64))


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` items: its number, and the places 0, 1, .. within it."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def word_edges(words: list[str]) -> tuple[np.ndarray, ...]:
    """``node, label, child, single`` of the second half of each word, in both directions: the
    edges of one code point, and the wide ones that a walk to the word's end takes."""
    parts = []
    for backwards in (False, True):
        p = Paths(words, backwards)
        low = np.maximum((p.n - 1) // 2, 0)  # a word one longer or shorter may come in here
        word, at = spread(p.n - low)
        at += low[word]
        width = widths(p.n[word] - at)
        one = np.ones_like(width)
        wide = width > 1
        for w, d, s in ((word, at, one), (word[wide], at[wide], width[wide])):
            parts.append((p.nodes(w, d), p.labels(w, d, s), p.nodes(w, d + s), s == 1))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def word_states(words: list[str]) -> tuple[np.ndarray, ...]:
    """``word, node, own, prev, (offsets, labels) here, (offsets, labels) next`` of every
    position from the middle of each word on: its own next code point (-1 at the end), the one
    before it (-1 at the middle), and the way to go from it and from the position after it."""
    parts = []
    for backwards in (False, True):
        p = Paths(words, backwards)
        half = p.n // 2
        word, at = spread(p.n - half + 1)
        at += half[word]
        inside, later = at < p.n[word], at > half[word]
        own, prev = np.full(len(at), -1), np.full(len(at), -1)
        own[inside] = p.codes[p.start[word[inside]] + at[inside]]
        prev[later] = p.codes[p.start[word[later]] + at[later] - 1]
        parts.append((word, p.nodes(word, at), own, prev, ways(p, word, at), ways(p, word, np.minimum(at + 1, p.n[word]))))
    joined = [np.concatenate([x[k] for x in parts]) for k in range(4)]
    return (*joined, *(tuple(np.concatenate([x[k][j] for x in parts]) for j in (0, 1)) for k in (4, 5)))


def ways(p: Paths, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of labels of each way from ``at`` to the word's end, and all the labels in order."""
    row, now, found = np.arange(len(at)), at.copy(), []
    while len(row):
        more = now < p.n[word[row]]
        row, now = row[more], now[more]
        width = widths(p.n[word[row]] - now)
        found.append((row, p.labels(word[row], now, width)))
        now = now + width
    rows, labels = (np.concatenate([x[k] for x in found]) if found else np.empty(0, np.int64) for k in (0, 1))
    return np.bincount(rows, minlength=len(at)), labels[np.argsort(rows, kind="stable")]


def word_slices(batches, most: int = 200_000):
    """Lists of (ids, words) with about ``most`` code points together."""
    for batch in batches:
        ids, words, size = [], [], 0
        for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(i)
            words.append(w)
            size += len(w)
            if size >= most:
                yield ids, words
                ids, words, size = [], [], 0
        if ids:
            yield ids, words


def edges_of(batches):
    import pyarrow as pa

    for _, words in word_slices(batches):
        node, label, child, single = word_edges(words)
        for k in range(0, len(node), 50_000):
            s = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[s]) for x in (node, label, child, single)], names=["node", "label", "child", "single"])


def states_of(batches):
    import pyarrow as pa

    def lists(counts, labels, s):
        ends = np.cumsum(counts)
        first = int(ends[s.start] - counts[s.start])
        last = int(ends[min(s.stop, len(ends)) - 1])
        return pa.ListArray.from_arrays(pa.array(np.r_[first, ends[s]] - first, pa.int32()), pa.array(labels[first:last]))

    for ids, words in word_slices(batches):
        word, node, own, prev, here, after = word_states(words)
        owner = np.array(ids, np.int64)[word]
        for k in range(0, len(node), 20_000):
            s = slice(k, k + 20_000)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[s]) for x in (owner, node, own, prev)), lists(*here, s), lists(*after, s)], names=["id", "node", "own", "prev", "here", "next"])


def ends_of(batches):
    import pyarrow as pa

    for ids, words in word_slices(batches):
        for backwards in (False, True):
            p = Paths(words, backwards)
            yield pa.RecordBatch.from_arrays([pa.array(p.nodes(np.arange(len(words)), p.n)), pa.array(ids, pa.int64())], names=["node", "id"])


def spread_join(states: DataFrame, n_states: int, edges: DataFrame, on: list[str], least: int = HOT_LEAST) -> DataFrame:
    """``states`` (landed, ``n_states`` rows) joined with ``edges``; the states of a hot key are
    spread over several parts, to each of which the key's edges go."""
    most = max(n_states // HOT_SHARE, least)
    hot = states.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*on, F.ceil(F.col("n") / most).cast("int").alias("parts"))
    hot = F.broadcast(hot)  # at most HOT_SHARE rows, as each stands for over 1/HOT_SHARE of the states
    parts = F.coalesce("parts", F.lit(1))
    salted = states.join(hot, on, "left").withColumn("salt", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("parts")
    repeated = edges.join(hot, on, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return salted.join(repeated.hint("merge"), [*on, "salt"]).drop("salt")


def near_pairs(words: DataFrame) -> DataFrame:
    """``id, near`` for each two of the landed ``words`` (``id, word, ..``) one edit apart, both ways round."""
    source = bounded_batches(words).select("id", "word")
    edges = land(source.mapInArrow(edges_of, EDGE_SCHEMA).distinct(), "trie-edges")
    starts = land(source.mapInArrow(states_of, STATE_SCHEMA), "trie-starts")
    ends = source.mapInArrow(ends_of, END_SCHEMA)

    first = F.col("prev") < 0
    deleted = starts.where((F.col("own") >= 0) & (first | (F.col("own") != F.col("prev")))).select("id", "node", F.col("next").alias("way"))
    # of equal letters in a row the first is deleted, and an insertion comes before them
    letters = edges.where("single").select("node", "label", "child")
    met = spread_join(starts, starts.count(), letters, ["node"])
    replaced = F.when((F.col("own") >= 0) & (F.col("label") != F.col("own")), F.col("next"))
    inserted = F.when(first | (F.col("label") != F.col("prev")), F.col("here"))
    edited = met.select("id", F.col("child").alias("node"), F.explode(F.array(replaced, inserted)).alias("way")).where("way is not null")
    frontier, found = land(deleted.unionByName(edited), "frontier"), []
    while True:
        found.append(frontier.where(F.size("way") == 0).select("id", "node"))
        going = frontier.where(F.size("way") > 0).select("id", "node", F.get("way", F.lit(0)).alias("label"), F.expr("slice(way, 2, size(way))").alias("way"))
        n = going.count()
        if not n:
            break
        moved = spread_join(going, n, edges.select("node", "label", "child"), ["node", "label"])
        frontier = land(moved.select("id", F.col("child").alias("node"), "way"), "frontier")
    ended = found[0]
    for more in found[1:]:
        ended = ended.unionByName(more)
    met = ended.join(ends.withColumnRenamed("id", "near"), "node").where("id <> near").select("id", "near").distinct()
    texts = words.select("id", "word")
    both = met.join(texts, "id").join(texts.select(F.col("id").alias("near"), F.col("word").alias("near_word")), "near")
    return land(both.where(F.levenshtein("word", "near_word", 1) == 1).select("id", "near"), "near-pairs")


def roots(forms: DataFrame) -> DataFrame:
    """``id, root`` for each row of the landed ``forms`` (``id, form_id``), following forms to the
    last: every round doubles the steps taken. A form occurs more often than its word, so
    chains end."""
    now = land(forms.where("form_id is not null").select("id", F.col("form_id").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("ahead"))
        moved = land(now.join(ahead, "root", "left").select("id", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), "roots")
        now = moved.select("id", "root")
        if not moved.where("moved").limit(1).count():
            return now


def variant_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of the landed ``words`` (``id, word, n``)."""
    pairs = near_pairs(words)
    other = words.select(F.col("id").alias("near"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = pairs.join(other, "near").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form"), F.col("near"))).alias("best"),  # strings compare by code point
    )
    kept = words.join(best, "id", "left").withColumn("is_form", -F.col("best.less") >= FORM_RATIO * F.col("n"))
    chosen = lambda c: F.when(F.col("is_form"), c)
    forms = land(
        kept.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            chosen(F.col("best.form")).alias("form"), chosen(-F.col("best.less")).alias("form_n"), chosen(F.col("best.near")).alias("form_id"),
        ),
        "forms",
    )
    led = roots(forms).join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return forms.join(led, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the texts of ``df``."""
    return variant_groups(spelled_words(df, id_col, text_col))
