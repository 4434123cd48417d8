from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from edge_cases import edge, edge_rows, nothing  # noqa: F401  (fixtures)
from feedlens.llm import alignment

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts: list[str | None], a_path: str, b_path: str) -> list[tuple]:
    """The figures by the libraries, token by token."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a_lib.encode_special_tokens = True
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {chr(b): b for b in visible}
    shown |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(visible)))}
    docs = []
    for text in texts:
        groups: list[tuple[list, list]] = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            raw_a = [bytes(shown[c] for c in a_lib.id_to_token(k)) for k in a]
            raw_b = []
            for k in b:
                piece = b_lib.id_to_piece(k)
                raw_b.append(bytes([int(piece[3:5], 16)]) if b_lib.is_byte(k) else piece.replace("▁", " ").encode())
            want = (" " + text).encode()
            if b"".join(raw_a) == want and b"".join(raw_b) == want:
                ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
                cuts = sorted(set(ends_a) & set(ends_b))
                groups = [([], []) for _ in cuts]
                for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
                    g = 0
                    for k, end in zip(ids, ends, strict=True):
                        while cuts[g] < end:
                            g += 1
                        groups[g][side].append(k)
        docs.append(groups)
    links = [Counter((x, y) for xs, ys in g for x in xs for y in ys) for g in docs]
    count = Counter(p for found in links for p in found)
    most: dict[int, int] = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for groups, found in zip(docs, links, strict=True):
        written = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((
            sum(len(xs) for xs, _ in groups), sum(len(ys) for _, ys in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in found.items()),
            hashlib.sha256(written.encode()).hexdigest() if groups else "",
        ))
    return out


def test_whole_table_against_the_libraries(spark, paths):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows], *paths), strict=True)}
    for heavy in (alignment.HEAVY_PAIRS, 40, 0):  # all pairs common, some, none
        got = {r.doc_id: tuple(r)[1:] for r in alignment.token_alignment(docs, *paths, heavy_pairs=heavy).collect()}
        assert got == want


def test_edge_cases(spark, paths, edge, edge_rows):
    special = [(400, "a <|endoftext|> b <s> </s>", "s", "", 0), (401, "x▁y", "s", "", 0), (402, " lead  two\n\n\ttab ", "s", "", 0), (403, "日本語のテキスト😀 Ωμέγα", "s", "", 0)]
    rows = edge_rows + special
    got = alignment.token_alignment(edge.union(spark.createDataFrame(special, edge.schema)), *paths)
    want = Counter((r[0], *w) for r, w in zip(rows, brute([r[1] for r in rows], *paths), strict=True))
    assert Counter(map(tuple, got.collect())) == want


def test_no_rows(paths, nothing):
    assert alignment.token_alignment(nothing, *paths).count() == 0


def test_ids_by_rank_are_the_librarys(paths):
    assert alignment.same_as_ranks(paths[0])
    texts = [" it's we'll  2024 \n\n end", " <|endoftext|>", " " + "a" * 3000, " 日本語 ñandú ---- ....", "  \t x" * 20, " ＡＢ́c‍﻿"]
    assert alignment.fast_ids(paths[0], True)(texts) == alignment.fast_ids(paths[0], False)(texts)
    import public_tokenizers

    assert not alignment.same_as_ranks(public_tokenizers.path("word_bpe_49k.json"))


def test_terminals_and_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 6)
    for _ in range(200):
        docs = int(rng.integers(1, 5))
        ends_a, ends_b, doc_cut = [], [], np.cumsum(rng.integers(1, 60, docs))
        for lo, hi in zip(np.r_[0, doc_cut[:-1]], doc_cut, strict=True):
            inner = np.arange(lo + 1, hi)
            ends_a += [*inner[rng.random(len(inner)) < 0.4], hi]
            ends_b += [*inner[rng.random(len(inner)) < 0.4], hi]
        a_end, b_end = np.array(ends_a), np.array(ends_b)
        last_a, last_b = alignment.terminals(a_end, b_end)
        cuts = np.intersect1d(a_end, b_end)
        assert (a_end[last_a] == cuts[np.searchsorted(cuts, a_end)]).all() and (a_end[last_b] == cuts[np.searchsorted(cuts, b_end)]).all()
        ga, gb = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        doc_of = np.searchsorted(doc_cut, cuts)
        a, b = rng.integers(0, 4, len(a_end)), rng.integers(0, 4, len(b_end))
        want = Counter()
        for x, g in zip(a.tolist(), ga.tolist(), strict=True):
            for y, h in zip(b.tolist(), gb.tolist(), strict=True):
                if g == h:
                    want[(int(doc_of[g]), x << 32 | y)] += 1
        got, seen = Counter(), []
        for doc, pair, times in alignment.pair_blocks(a, ga, b, gb, doc_of):
            seen += zip(doc.tolist(), pair.tolist(), strict=True)
            got.update(dict(zip(zip(doc.tolist(), pair.tolist(), strict=True), times.tolist(), strict=True)))
        assert got == want and len(seen) == len(set(seen))
