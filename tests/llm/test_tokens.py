from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from edge_cases import edge, edge_rows, nothing  # noqa: F401  (fixtures)
from feedlens.llm import packing, token_binary, token_count
from feedlens.llm.common import scratch_path
from feedlens.llm.word_ids import WordIds

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}
ODD = ["", "  ", "it's <|endoftext|> x", "'S don't ''s !'ll", "a\x1cb\x85c\xa0d   x", "日本語 text 12³½", "Σας İ é", " " * 50 + "x" * 5000, "\t a\r\n\r\nb", "<|startoftext|>a", "é ́x"]


def ids(text, end):
    return np.array([*LIBRARY[WORD].encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r'.,!?abcXYZ019éßñ\x1c "), st.characters(codec="utf-8")), max_size=60))
def test_words_and_counts_agree_with_the_library(text):
    assert WORDS.encode([text.encode()])[0] == np.array(LIBRARY[WORD].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert COUNTER.count([text]) == [len(LIBRARY[BYTE].encode(text, add_special_tokens=False).ids)]


WORDS, COUNTER = WordIds(WORD), token_count.Counter(BYTE, token_count.whole_tokens(BYTE))


def test_odd_texts():
    for text in ODD:
        assert WORDS.encode([text.encode()])[0] == np.array(LIBRARY[WORD].encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text
        assert COUNTER.count([text]) == [len(LIBRARY[BYTE].encode(text, add_special_tokens=False).ids)], text


def test_simple_words_keep_their_ids():
    """Every letter below the bound, in a word of letters."""
    letters = [ch for ch in map(chr, range(ord("ɐ"))) if ch.isalpha()]
    for ch in letters:
        text = f"a{ch}b {ch}{ch} X{ch}"
        assert WordIds.encode(WORDS, [text.encode()])[0] == np.array(LIBRARY[WORD].encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_words_by_ranks_are_the_librarys():
    """Words with stops, quotes, digits, symbols and accents, and capitals beside a special string."""
    words = ["l'été,", "(a1b2)", "it's", "we'll'd", "--x--", "¿qué?", "3,14", "a.b.c", "x×y÷z", "don't.", "“q”", "naïve's", "A|b<c", "ÀÉÎ's", "ǅabc1", "a\x01b", "\x01", "e\u0301t"]
    for text in [*words, " ".join(words), "<| Hello WORLD É's <|x", "Hello <|endoftext|> World's"]:
        assert WordIds(WORD).encode([text.encode()])[0] == np.array(LIBRARY[WORD].encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def test_unknown_tokenizer_files_are_refused(tmp_path):
    import json

    from feedlens.llm import word_ids

    with pytest.raises(ValueError, match="word ends"):
        WordIds(BYTE)
    with open(WORD, encoding="utf-8") as f:
        file = json.load(f)
    for change in ({"normalizer": None}, {"added_tokens": [*file["added_tokens"], {"id": 49408, "content": "[x]", "normalized": False, "lstrip": False, "rstrip": False, "single_word": False, "special": True}]}):
        (tmp_path / "other.json").write_text(json.dumps(file | change), encoding="utf-8")
        with pytest.raises(ValueError):
            word_ids.checked_file(str(tmp_path / "other.json"))


def test_unreachable_tokens_get_no_rank():
    from feedlens.llm import byte_ranks

    model = {"type": "BPE", "vocab": {c: k for k, c in enumerate(byte_ranks.byte_letters())}, "merges": ["a b", "b c", "a bc"]}
    model["vocab"] |= {"ab": 256, "bc": 257, "abc": 258}  # abc alone is ab, c: its own merge never comes about
    assert byte_ranks.reachable(model, ["ab", "bc", "abc"]) == {"ab", "bc"}
    ranks, _ = byte_ranks.ranked(model)
    assert b"bc" in ranks and b"abc" not in ranks
    coded, ids = byte_ranks.coding(model, "[^ ]+")
    assert [int(ids[k]) for k in coded.encode_ordinary("abc bc")] == [256, model["vocab"]["c"], 257]


def test_counts_refuse_unknown_files():
    with pytest.raises(ValueError, match="known pattern"):
        token_count.whole_tokens(WORD)


def test_repeated_attempt_keeps_the_first_file(tmp_path):
    from pyarrow import fs

    class NoOverwrite:  # as hdfs does
        def __init__(self):
            self.inner = fs.LocalFileSystem()

        def move(self, a, b):
            if self.inner.get_file_info(b).type == fs.FileType.File:
                raise OSError("exists")
            self.inner.move(a, b)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    for attempt in ("first", "second"):
        (tmp_path / attempt).write_text(attempt)
        token_binary.keep_first(NoOverwrite(), str(tmp_path / attempt), str(tmp_path / "final"))
    assert (tmp_path / "final").read_text() == "first" and not (tmp_path / "second").exists()
    assert token_binary.vocabulary_size(WORD, 2) == 49_408 and token_binary.vocabulary_size(WORD, 70_000) == 70_001


def test_memo_generations(monkeypatch):
    from feedlens.llm import word_ids

    monkeypatch.setattr(word_ids, "MEMO_WORDS", 5)
    w = WordIds(WORD)
    texts = [f"alpha beta w{i} x{i} y{i}" for i in range(30)]
    assert [w.encode([t.encode()])[0] for t in texts] == [ids(t, 0)[:-1].tobytes() for t in texts]


def test_character_classes_are_the_librarys_below_the_safe_bound():
    cut = LIBRARY[BYTE].pre_tokenizer
    for ch in map(chr, range(ord(token_count.SAFE_BELOW))):
        for s in (f"a{ch}a", f"1{ch}1", f"!{ch}!", f" {ch}{ch} x"):
            assert [s[i:j] for _, (i, j) in cut.pre_tokenize_str(s)] == (COUNTER.ascii_cut(s) if s.isascii() else COUNTER.cut(s))


def test_whole_tokens_are_proven():
    whole = token_count.whole_tokens(BYTE)
    assert len(whole) > 49_000 and " the" in whole
    for s in whole[::997]:
        assert len(LIBRARY[BYTE].encode(s, add_special_tokens=False).ids) == 1


def test_token_counts_edge_cases(edge, edge_rows, nothing):
    got = sorted(map(tuple, token_count.token_counts(edge, BYTE).collect()), key=str)
    want = [(r[0], len((r[1] or "").encode()), len(LIBRARY[BYTE].encode(r[1] or "", add_special_tokens=False).ids)) for r in edge_rows]
    assert got == sorted(want, key=str)
    assert token_count.token_counts(nothing, BYTE).count() == 0


def test_token_binary_round_trip(spark, edge, edge_rows, nothing):
    path = scratch_path(spark, "test-binary")
    token_binary.write(edge, path, WORD, 49_408, 2, length=64)
    got = sorted(((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in token_binary.read_documents(spark, path, length=64).collect()), key=lambda r: r[0])
    stream, at = b"", 0
    for start, _, n, own in got:
        assert (start, 4 * n) == (at, len(own))
        at, stream = at + n, stream + own
    assert sorted((str(i), own) for _, i, _, own in got) == sorted((str(r[0]), ids(r[1], 2).tobytes()) for r in edge_rows)
    order = [i for _, i, _, _ in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    # the sequences, with their padding masked, are the stream
    held = []
    for shard in sorted({r.shard for r in spark.read.parquet(f"{path}/index").collect()}):
        reader = token_binary.open_shard(path, shard)
        rows = sum(reader.get_batch(k).num_rows for k in range(reader.num_record_batches))
        for row in range(rows):
            values, mask = token_binary.sequence(path, shard, row)
            assert len(values) == len(mask) == 64 and str(values.type) == "uint16"
            held.append(values.to_numpy()[mask.to_numpy(zero_copy_only=False)])
    assert np.concatenate(held).astype("<u4").tobytes() == stream
    assert token_binary.token_binary(nothing, WORD, 49_408, 2).count() == 0


def check_packing(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in places.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pack_documents_edge_cases(edge, edge_rows, nothing):
    got = packing.pack_documents(edge, WORD, 1).collect()
    n = check_packing(got, 4096)
    assert n <= -(-sum(r.length for r in got) // 4096) + 1
    want = []
    for r in edge_rows:
        x = ids(r[1], 1)
        want += [(r[0], k, k * 4096, len(x[k * 4096 : (k + 1) * 4096]), zlib.crc32(x[k * 4096 : (k + 1) * 4096].tobytes())) for k in range(-(-len(x) // 4096))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    assert packing.pack_documents(nothing, WORD, 1).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_everything(seed):
    rng = np.random.default_rng(seed)
    lengths = [np.minimum(4096, rng.lognormal(6.5, 1.2, 20_000).astype(int) + 1), rng.integers(1, 4097, 20_000), rng.integers(900, 1800, 20_000), np.full(5000, 1365), np.array([4096, 1, 1, 4095])][seed]
    values, counts = np.unique(lengths, return_counts=True)
    bins = packing.plan(dict(zip(values, counts, strict=True)))
    placed = {}
    for b in bins:
        assert b.count > 0 and sum(n * c for n, c in b.items) <= 4096
        for n, c in b.items:
            placed[n] = placed.get(n, 0) + c * b.count
    assert placed == {int(v): int(c) for v, c in zip(values, counts, strict=True)}
    bound = max(-(-lengths.sum() // 4096), (lengths > 2048).sum())
    assert sum(b.count for b in bins) <= bound * 1.025 + 2


def test_plan_rejects_lengths_beyond_the_capacity():
    with pytest.raises(ValueError):
        packing.plan({5000: 1})


def test_workers_need_no_package(tmp_path):
    """Python workers that cannot import ``feedlens``: functions and classes go by value."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from feedlens.session import local_session
from feedlens.llm import lm_score, near_dedup, packing, quality_rules
spark = local_session(cores=2, shuffle_partitions=2)
docs = spark.createDataFrame([(i, "some words of a text number %d" % (i // 2)) for i in range(6)], "doc_id bigint, text string")
print("ROWS", packing.pack_documents(docs, {WORD!r}, 1).count(), quality_rules.quality_rules(docs).count(),
      near_dedup.near_duplicates(docs).where("kept").count(), lm_score.lm_scores(docs).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert "ROWS 6 6 3 6" in out.stdout
