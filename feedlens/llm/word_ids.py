"""Token ids of whole texts by a tokenizer whose tokens never span ASCII white space.

Such a tokenizer (``word_bpe_49k.json`` cuts at white space before merging) encodes a text as
the concatenation of its white-space words' ids, so each Python worker keeps the ids of words
it has met, in a memo of bounded size. New words of letters are merged by ranks, many in one
call (``byte_ranks``: the same merges, proved on the file); all others go to the library. Ids are
little-endian unsigned 32-bit bytes throughout.

A-Z are lower-cased first, which leaves the ids as they are and makes fewer distinct words (the
tokenizer does so itself, after matching its special strings, so texts that may hold one are
left alone). A stop or comma that ends a word after a-z is a pre-token of its own, so such a
word's ids are those of the two parts.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

from feedlens.llm.byte_ranks import MARK, coding, model_of, plain_bpe
from feedlens.llm.common import worker_state

#: Words in each of a memo's two generations (about 330 bytes a word), the longest word kept, and words given to the library as one text.
MEMO_WORDS, MEMO_BYTES, CALL_WORDS, SIMPLE_WORDS = 250_000, 64, 500, 5000
#: Letters below this code point are single code points in every normal form and case (but for the dotted capital I).
SIMPLE_BELOW, DOTTED_I = "ɐ", "İ"
#: Words whose pre-tokens are found here: visible ASCII and the letters from U+00C0 on below that bound.
SAFE = re.compile(r"[!-~\u00C0-\u024F]+")
#: The pattern of pre-tokens between white space that the shortcuts rely on; fixed by the tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def checked_file(path: str) -> dict:
    """The tokenizer file, if it is one that this module knows; a ValueError says what is not."""
    file = model_of(path)
    steps = (file["normalizer"] or {}).get("normalizers", [])
    cuts = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])
    known = {
        "a byte-level BPE with word ends": plain_bpe(file["model"]) and bool(file["model"].get("end_of_word_suffix")),
        "normaliser NFC, white space, lower case": [(s["type"], s.get("pattern"), s.get("content")) for s in steps] == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)],
        "pre-tokens cut at white space": cuts[0].get("pattern") == {"Regex": PATTERN} and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert") is True,
        "bytes without a pattern of their own": cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and cuts[1].get("use_regex") is False and len(cuts) == 2,
        "special strings that begin with <|": all(t["content"].startswith("<|") and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]) for t in file["added_tokens"]),
        "no template, cut or filling": file.get("truncation") is None and file.get("padding") is None,
    }
    if missing := [what for what, found in known.items() if not found]:
        raise ValueError(f"{path} is not as the word encoder needs it: {'; '.join(missing)}")
    return file


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        file = checked_file(path)
        self.tokenizer = Tokenizer.from_file(path)
        import regex

        self.cut = regex.compile(PATTERN).findall
        self.ranks, self.file_ids = coding(file["model"], "[^ ]+")
        suffix = file["model"]["end_of_word_suffix"]
        ending = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)  # the tokens that end a word
        ending[[k for token, k in file["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.ends = ending[self.file_ids]  # by rank
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the generation before
        self.frequent: dict[bytes, bytes] = {}  # words met in two generations: they stay on
        self.stops = {ord(c): np.array(self.tokenizer.encode(c, add_special_tokens=False).ids, "<u4").tobytes() for c in ".,"}

    def learn(self, words: set[bytes]) -> None:
        """Put ``words`` into the memo."""
        known = {w: self.older[w] for w in words.intersection(self.older)}
        self.memo |= known
        self.frequent |= known
        words = words.difference(known)
        stopped = [w for w in words if w[-1] in self.stops and w[-2:-1].isalpha()]
        whole = words.difference(stopped)
        whole.update(w for w in (x[:-1] for x in stopped) if w not in self.memo)
        self._ask(list(whole))
        for word in stopped:
            self.memo[word] = self.memo[word[:-1]] + self.stops[word[-1]]

    def _ask(self, words: list[bytes]) -> None:
        """Merge these words, or ask the library for them, many in one text."""
        simple, cut, other = [w for w in words if w.isalpha()], [], []  # bytes: a-z and A-Z only
        texts = b" ".join(simple).decode().lower().split()
        for word in words:
            if word.isalpha():
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha() and max(text) < SIMPLE_BELOW and DOTTED_I not in text:
                simple.append(word)
                texts.append(text.lower())
            elif SAFE.fullmatch(text) and "<|" not in text and DOTTED_I not in text:
                cut.append((word, self.cut(text.lower())))
            else:
                other.append(word)
        self._merge(simple, texts, None)
        self._merge([w for w, _ in cut], [p for _, pieces in cut for p in pieces], [len(pieces) for _, pieces in cut])
        for k in range(0, len(other), CALL_WORDS):
            own = other[k : k + CALL_WORDS]
            texts = [w.decode("utf-8", "replace") for w in own]
            encoding = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
            begins = np.array([a for a, _ in encoding.offsets], dtype=np.int64)
            starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
            ids = np.array(encoding.ids, dtype="<u4")
            self._keep(own, ids.tobytes(), [*np.searchsorted(begins, starts).tolist(), len(ids)])

    def _merge(self, words: list[bytes], pieces: list[str], counts: list[int] | None) -> None:
        """Words by the ranks of their pre-tokens ``pieces``: one each, or as ``counts`` says."""
        ends = np.arange(1, len(words) + 1) if counts is None else np.cumsum(counts)
        at = 0
        while at < len(words):
            first = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, first + SIMPLE_WORDS, "right")))
            ranks = np.array(self.ranks.encode_ordinary((MARK + " ").join(pieces[first : int(ends[to - 1])]) + MARK), dtype=np.int64)
            borders = np.r_[0, np.flatnonzero(self.ends[ranks]) + 1]
            self._keep(words[at:to], self.file_ids[ranks].tobytes(), borders[np.r_[first, ends[at:to]] - first].tolist())
            at = to

    def _keep(self, words: list[bytes], ids: bytes, cuts: list[int]) -> None:
        for k, word in enumerate(words):
            self.memo[word] = ids[4 * cuts[k] : 4 * cuts[k + 1]]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.memo) > MEMO_WORDS:
            if len(self.frequent) > MEMO_WORDS // 2:
                self.frequent = {}
            self.memo, self.older = dict(self.frequent), self.memo
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        flat = list(chain.from_iterable(split))
        ids = list(map(self.memo.get, flat))
        missing = [k for k, x in enumerate(ids) if x is None]
        new = {flat[k] for k in missing}
        self.learn(new)
        for k in missing:
            ids[k] = self.memo[flat[k]]
        for word in new:
            if len(word) > MEMO_BYTES:
                del self.memo[word]
        out, at = [], 0
        for words in split:
            out.append(b"".join(ids[at : at + len(words)]))
            at += len(words)
        return out


def encoder(path: str) -> WordIds:
    """This worker's encoder for ``path``."""
    return worker_state(f"word_ids:{path}", lambda: WordIds(path))
