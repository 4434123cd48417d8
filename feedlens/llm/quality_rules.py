"""Quality rules by repetition coverage.

For each text, rolling hashes of word n-grams (several n) find the n-grams that occur again;
the characters of words inside a repeated occurrence are counted once however many n-grams
cover them, and likewise the characters of repeated lines. A document goes when too large a
share of its characters is repeated, when it has too few words, or too many symbols a word.

The hash of a window is a sum of products of its word hashes with odd constants, taken over
the whole slice at once in numpy; sorting brings equal windows together and every group of
equal hashes is compared word by word, so a chance collision cannot count.

Defined cases: null and empty texts have no words and are dropped (fewer than ``min_words``);
very long texts are handled whole, one at a time; each row is judged alone, so ties, repeated
rows, null ids and further columns do not matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from feedlens.llm.common import bounded_batches, segment_sums, slices, texts_of, word_hashes

#: Largest share of characters inside repeated n-grams, by n; the first occurrence does not count.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of characters inside repeated lines.
LINE_LIMIT = 0.20
#: Most symbols a word.
SYMBOL_LIMIT = 0.5
#: Base rules.
MIN_WORDS, BASE_N, BASE_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, dup_line_share double, dup_ngram_shares array<double>"
)


def repeated_windows(codes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the n-word windows that occur twice or more in their document: all of them,
    and those that are not the first of their kind. ``codes``: a number for each word, equal
    for equal words; ``doc``: the document of each word, ascending."""
    count = len(codes) - n + 1
    if count < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(doc[:count] == doc[n - 1 :])
    for seed in range(8):
        factors = np.random.default_rng([seed, n]).integers(1, 2**62, n + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        rolled = doc[:count].astype(np.uint64) * factors[n]
        for j in range(n):
            rolled += (codes[j : count + j] ^ (codes[j : count + j] >> np.uint64(29))) * factors[j]
        rolled = rolled[start]
        order = np.argsort(rolled, kind="stable")
        by = start[order]
        same = rolled[order][1:] == rolled[order][:-1]
        a, b = by[1:][same], by[:-1][same]
        if (doc[a] == doc[b]).all() and all((codes[a + j] == codes[b + j]).all() for j in range(n)):
            later = np.r_[False, same]
            return np.sort(by[later | np.r_[same, False]]), np.sort(by[later])
    raise AssertionError("eight independent hashes collided")


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a window that starts at one of ``starts``."""
    edge = np.zeros(words + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and their characters without white space."""
    if b"\n" not in text:
        return 0, 0
    seen, lines, chars = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                lines += 1
                chars += len(b"".join(line.split()).decode("utf-8", "replace"))
            seen.add(line)
    return lines, chars


def measure(texts: list[bytes], limits: dict[int, float] = NGRAM_LIMITS) -> dict[str, np.ndarray]:
    """The figures of each text."""
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], dtype=np.int64)
    ends = np.cumsum(n_words)
    starts = ends - n_words
    flat = [w for words in split for w in words]
    del split
    codes = word_hashes(flat)
    # code points of a word: bytes that do not continue one
    data = np.frombuffer(b"".join(flat), dtype=np.uint8)
    byte_ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)))
    chars = segment_sums(((data & 0xC0) != 0x80).view(np.uint8), np.r_[0, byte_ends[:-1]].astype(np.int64), byte_ends) if len(flat) else np.empty(0, np.int64)
    is_symbol = np.zeros(256, dtype=np.uint8)
    is_symbol[list(SYMBOLS)] = 1
    doc = np.repeat(np.arange(len(texts)), n_words)
    symbols = segment_sums(segment_sums(is_symbol[data], np.r_[0, byte_ends[:-1]].astype(np.int64), byte_ends), starts, ends) if len(flat) else np.zeros(len(texts), np.int64)
    word_chars = segment_sums(chars, starts, ends)
    lines = np.array([repeated_lines(t) for t in texts], dtype=np.int64).reshape(-1, 2)
    shares = np.zeros((len(texts), len(limits)))
    repeat_words = np.zeros(len(texts), np.int64)
    everywhere, later = repeated_windows(codes, doc, BASE_N)
    repeat_words = segment_sums(covered(everywhere, BASE_N, len(flat)).view(np.uint8), starts, ends)
    hit = np.zeros(len(texts), bool)
    hit[doc[everywhere]] = True
    # an n-gram longer than BASE_N that repeats holds one of BASE_N that does: other texts need no look
    some = np.flatnonzero(hit[doc]) if len(flat) else np.empty(0, np.int64)
    for k, n in enumerate(sorted(limits)):
        if n < BASE_N:
            at = repeated_windows(codes, doc, n)[1]
        else:
            at = later if n == BASE_N else some[repeated_windows(codes[some], doc[some], n)[1]]
        inside = covered(at, n, len(flat))
        shares[:, k] = segment_sums(np.where(inside, chars, 0), starts, ends) / np.maximum(word_chars, 1)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": lines[:, 0], "n_repeat_words": repeat_words, "line_share": lines[:, 1] / np.maximum(word_chars, 1), "shares": shares}


def _judge(batches, limits, line_limit, symbol_limit):
    import pyarrow as pa

    for batch in batches:
        for part in slices(batch):
            m = measure(texts_of(part), limits)
            failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
            most = np.array([limits[n] for n in sorted(limits)])
            kept = ~failed & (m["shares"] <= most).all(1) & (m["line_share"] <= line_limit) & (m["n_symbols"] <= symbol_limit * m["n_words"])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(m[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), pa.array(failed), pa.array(kept), pa.array(m["line_share"]), pa.array(list(m["shares"]), pa.list_(pa.float64()))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "dup_line_share", "dup_ngram_shares"],
            )


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: dict[int, float] = NGRAM_LIMITS, line_limit: float = LINE_LIMIT, symbol_limit: float = SYMBOL_LIMIT) -> DataFrame:
    """One row for each row of ``df``: its figures, ``base_failed`` and ``kept``."""
    chosen = bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    return chosen.mapInArrow(lambda batches: _judge(batches, limits, line_limit, symbol_limit), SCHEMA)


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, with all their columns (map-side, no shuffle)."""
    names = df.columns
    at = names.index(text_col)
    limits = dict(NGRAM_LIMITS)

    def judge(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, at):
                alone = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), part.column(at)], names=["doc_id", "text"])
                kept = [x.column("kept") for x in _judge([alone], limits, LINE_LIMIT, SYMBOL_LIMIT)]
                yield part.filter(pa.chunked_array(kept).combine_chunks())

    return bounded_batches(df).mapInArrow(judge, df.schema)
