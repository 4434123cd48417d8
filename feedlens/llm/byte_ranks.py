"""A byte-level BPE file as ranks of byte strings, for ``tiktoken``.

The library merges *pairs* in the order of the file; ``tiktoken`` merges neighbours whose joined
bytes have the lowest rank. Both give the same tokens if every ranked token is *reachable*,
that is, if its own bytes alone merge into it: as long as the two ends of a stretch of bytes
are borders between tokens, what happens inside does not depend on what is around it, so at a
reachable token's rank its stretch is cut as its own merge has it, and afterwards it is one
token. A token that its own bytes do not reach is reached nowhere, and gets no rank.
``reachable`` asks the library for each.

With an end-of-word suffix, ``MARK`` stands for it: one byte after each word, merged with the
word's last byte before anything else.
"""

from __future__ import annotations

import json

import numpy as np

from feedlens.llm.token_count import byte_letters

#: Stands for the end-of-word suffix; words that hold it are encoded otherwise.
MARK = "\x01"


def model_of(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def plain_bpe(model: dict) -> bool:
    """A BPE over byte letters without options that change merging."""
    options = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
    return model["type"] == "BPE" and not any(model.get(k) for k in options) and all(c in model["vocab"] for c in byte_letters())


def merge_pairs(model: dict) -> list[tuple[str, str]]:
    return [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]


def reachable(model: dict, tokens: list[str]) -> set[str]:
    """The ``tokens`` that the merges make of their own letters alone."""
    from tokenizers import models

    merges, suffix = merge_pairs(model), model.get("end_of_word_suffix") or None
    inside = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
    ending = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, end_of_word_suffix=suffix) if suffix else inside
    out = set()
    for token in tokens:
        ends = suffix and token.endswith(suffix)
        found = (ending if ends else inside).tokenize(token.removesuffix(suffix) if ends else token)
        if [t.id for t in found] == [model["vocab"][token]]:
            out.add(token)
    return out


def ranked(model: dict) -> tuple[dict[bytes, int], np.ndarray]:
    """Ranks of byte strings, and the file's id for each rank."""
    letters, vocab, suffix = byte_letters(), model["vocab"], model.get("end_of_word_suffix") or ""
    by_byte = {b: c for c, b in letters.items()}
    ranks = {bytes([b]): b for b in range(256)}
    ids = [vocab[by_byte[b]] for b in range(256)]
    if suffix:
        ranks |= {bytes([b]) + MARK.encode(): 256 + b for b in range(256)}
        ids += [vocab[by_byte[b] + suffix] for b in range(256)]
    made = [a + b for a, b in merge_pairs(model)]
    known = reachable(model, made)
    for token in made:
        if token in known:
            ends = suffix and token.endswith(suffix)
            raw = bytes(letters[c] for c in token.removesuffix(suffix)) + MARK.encode() if ends else bytes(letters[c] for c in token)
            if raw not in ranks:
                ranks[raw] = len(ids)
                ids.append(vocab[token])
    return ranks, np.array(ids, dtype="<u4")


def coding(model: dict, pattern: str):
    """``(tiktoken's encoding, the file's id of each of its ids)`` for texts cut by ``pattern``."""
    import tiktoken

    ranks, ids = ranked(model)
    first = 512 if model.get("end_of_word_suffix") else 256
    if ids[:first].max() < ids[first:].min(initial=2**32 - 1) and (np.diff(ids[first:].astype(np.int64)) > 0).all():
        ranks, ids = {raw: int(ids[k]) for raw, k in ranks.items()}, np.arange(ids.max() + 1, dtype="<u4")  # the ids rank alike
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), ids
