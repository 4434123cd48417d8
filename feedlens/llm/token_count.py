"""Token counts with a whole-token shortcut.

A byte-level BPE cuts a text into pre-tokens and merges each alone. Most pre-tokens are
vocabulary entries that the merges reach: for those the count is one without any merging.
``whole_tokens`` proves offline, on the driver, which entries these are: it gives every
vocabulary string to the library and keeps those that come back as one pre-token and one
token. Tasks cut texts with the same pattern, count proven pre-tokens directly, and have the
library merge only the rest, once for each distinct one in a bounded memo.

The pattern runs in Python only on texts whose characters are all below ``SAFE_BELOW`` and
that hold no special string; there its character classes are those of the library (a test
compares every code point). Any other text goes to the library whole.

Defined cases: null and empty texts have 0 bytes and 0 tokens; very long texts are whole;
ties, repeated rows, null ids and further columns do not matter: rows are judged alone.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame

from feedlens.llm.common import bounded_batches, slices, texts_of, worker_state

#: Character classes are compared with the library's below this code point.
SAFE_BELOW = "ɐ"
#: Distinct pre-tokens kept in a worker's memo beyond the proven ones, and the longest kept.
MEMO, MEMO_CHARS = 500_000, 64
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint"

# The pre-token pattern of byte-level BPE, fixed by the tokenizer file, and the same for ASCII texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter for each byte, inverted: printable bytes stand for themselves,
    the others for code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def whole_tokens(tokenizer: str) -> list[str]:
    """The strings that are one pre-token and encode alone as one token. A file with another
    pattern or normaliser than this module's raises a ValueError."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    file = json.loads(library.to_str())
    cut = file["pre_tokenizer"] or {}
    if file["normalizer"] is not None or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        raise ValueError(f"{tokenizer}: not a byte-level BPE with the known pattern and no normaliser")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in file["added_tokens"]):
        raise ValueError(f"{tokenizer}: its special strings take in more than themselves")
    letters, strings = byte_letters(), []
    for token in file["model"]["vocab"]:
        raw = bytes(letters[c] for c in token) if all(c in letters for c in token) else b"\xff"
        try:
            strings.append(raw.decode("utf-8"))
        except UnicodeDecodeError:
            continue  # a part of a character is never a pre-token
    cut = library.pre_tokenizer
    encoded = library.encode_batch(strings, add_special_tokens=False)
    return [s for s, e in zip(strings, encoded, strict=True) if len(e.ids) == 1 and len(cut.pre_tokenize_str(s)) == 1]


class Counter:
    def __init__(self, tokenizer: str, whole: list[str]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import re

        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.proven = dict.fromkeys(whole, 1)
        self.memo = dict(self.proven)
        self.ascii_cut, self.cut = re.compile(ASCII_PATTERN, re.A).findall, regex.compile(PATTERN).findall

    def pieces(self, text: str) -> list[str] | None:
        """The text's pre-tokens, or None if the library must have it whole."""
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return self.ascii_cut(text)
        return self.cut(text) if max(text) < SAFE_BELOW else None

    def count(self, texts: list[str]) -> list[int]:
        if len(self.memo) > len(self.proven) + MEMO:
            self.memo = dict(self.proven)
        cut = [self.pieces(t) for t in texts]
        new = list(set().union(*(p for p in cut if p is not None)).difference(self.memo))
        for piece, found in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False), strict=True):
            self.memo[piece] = len(found.ids)
        get = self.memo.__getitem__
        out = [sum(map(get, p)) if p is not None else len(self.library.encode(t, add_special_tokens=False).ids) for t, p in zip(texts, cut, strict=True)]
        for piece in new:
            if len(piece) > MEMO_CHARS:
                del self.memo[piece]
        return out


def token_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for each row of ``df``."""
    whole = whole_tokens(tokenizer)  # bounded by the vocabulary

    def count(batches):
        import pyarrow as pa

        counter = worker_state(f"counter:{tokenizer}", lambda: Counter(tokenizer, whole))
        for batch in batches:
            for part in slices(batch):
                raw = texts_of(part)
                n = counter.count([t.decode("utf-8", "replace") for t in raw])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in raw], pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(count, SCHEMA)
