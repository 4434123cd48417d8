"""Alignment of two tokenizers' tokens over the same bytes.

1. A Python task encodes space + text with tokenizer A (byte-level BPE) and the text with
   tokenizer B (SentencePiece, which adds the space) and keeps the texts whose token bytes
   join to space + text on both sides.
2. Groups by pointer jumping: every token points to its farthest-right overlapping token, the
   last token of its group points to itself, and ``succ = succ[succ]`` over all tokens of a
   slice of texts doubles the steps until nothing moves. The terminal token is the group.
3. The links of a text, all A-B occurrence pairs within a group, are kept as distinct id pairs
   with their number of occurrences, landed with the text's figures. In the same pass a task
   hands on how many texts hold each pair (numpy counts); Spark adds them up.
4. A second pass over the landed pairs (nothing is encoded twice) looks up the counts of the
   commonest pairs, at most ``HEAVY_PAIRS``, in a sorted array that is broadcast. The other
   pairs are joined by Spark: each is held by fewer texts than any common one, so no key of
   that join is hot however the tokens are spread. Sums by text are added to the figures.

``fast_ids`` encodes A by ranks of bytes (``byte_ranks``, which proves the same merges) when a
check on the driver shows that the file is a plain byte-level BPE with the known pattern and
nothing in front of it; otherwise the library itself encodes.

A text's links go out in blocks of whole A ids with about ``BLOCK_PAIRS`` pairs, so a text
whose tokens never end together needs bounded memory too.

Defined cases: null and empty texts, and texts whose bytes differ on either side, have zeros
and an empty digest; very long texts are handled whole; each row is a document of its own, so
rows repeated count as often as they occur, and null ids do not matter; an empty table gives
no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.byte_ranks import coding, model_of, plain_bpe
from feedlens.llm.common import bounded_batches, land, slices, texts_of, worker_state
from feedlens.llm.token_count import PATTERN, byte_letters

#: Common pairs whose counts are broadcast (16 bytes each), and pairs of one block.
HEAVY_PAIRS, BLOCK_PAIRS = 1_000_000, 2_000_000
#: Pairs whose counts a task holds before it hands them on.
HELD_PAIRS = 2_000_000
#: Groups with over so many links are paired by distinct ids.
WIDE_GROUP = 256
LEFT = np.int64(1 << 32)  # a pair is a * LEFT + b

FIGURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
SCHEMA = f"row bigint, doc_id bigint, {FIGURES}, pairs binary, times binary, pair bigint, n bigint"


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level BPE file."""
    file, letters = model_of(path), byte_letters()
    out = [b""] * (1 + max([*file["model"]["vocab"].values(), *(t["id"] for t in file["added_tokens"])]))
    for token, k in file["model"]["vocab"].items():
        out[k] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
    return out


def piece_tokens(model) -> list[bytes]:
    """The bytes of each id of a SentencePiece model."""
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    coded = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) for p in pieces]
    return [bytes([int(c[1], 16)]) if c else p.replace("▁", " ").encode() for p, c in zip(pieces, coded, strict=True)]


def same_as_ranks(path: str) -> bool:
    """Whether the file is a byte-level BPE that ranks of bytes give too (``byte_ranks``): the
    known pattern, nothing else in front, no options of the model."""
    file, cut = model_of(path), model_of(path)["pre_tokenizer"] or {}
    return (
        plain_bpe(file["model"]) and not file["model"].get("end_of_word_suffix") and file["normalizer"] is None
        and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    )


def fast_ids(path: str, by_ranks: bool):
    """A function from texts to lists of ids, special strings being plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if by_ranks:
        ranks, ids = coding(model_of(path)["model"], PATTERN)
        to_id = ids.tolist()
        if to_id == list(range(len(to_id))):
            return lambda texts: [ranks.encode_ordinary(t) for t in texts]
        return lambda texts: [[to_id[k] for k in ranks.encode_ordinary(t)] for t in texts]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]


class Codes:
    """Both tokenizers, the lengths of their tokens, and their ids written out with each separator."""

    def __init__(self, a_path: str, b_path: str, by_ranks: bool):
        import sentencepiece

        self.encode_a = fast_ids(a_path, by_ranks)
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a, self.b = byte_tokens(a_path), piece_tokens(self.model)
        self.a_len, self.b_len = (np.array([len(t) for t in x], np.int64) for x in (self.a, self.b))
        written = [f"{k}{end}" for ends, count in ((",|", len(self.a)), (",;", len(self.b))) for end in ends for k in range(count)]
        self.written = np.array(written, dtype=object)

    def encode(self, raw: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides for each text; none where the bytes differ."""
        texts = [t.decode("utf-8", "replace") for t in raw]
        a = self.encode_a([" " + t if t else "" for t in texts])
        b = self.model.encode(texts, num_threads=1)
        for k, t in enumerate(raw):
            whole = b" " + t
            if not t or b"".join(map(self.a.__getitem__, a[k])) != whole or b"".join(map(self.b.__getitem__, b[k])) != whole:
                a[k], b[k] = [], []
        return a, b


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (an A token) of the group of every A and B token, from the ends of
    their byte ranges; both sides cover the same bytes."""
    na = len(a_end)
    over_b = np.searchsorted(b_end, a_end, "left")  # the B token over an A token's last byte
    over_a = np.searchsorted(a_end, b_end, "left")
    succ = np.r_[np.where(b_end[over_b] > a_end, na + over_b, np.arange(na)), over_a]
    while True:
        further = succ[succ]
        if (further == succ).all():
            return succ[:na], succ[na:]
        succ = further


def joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and the list each comes from."""
    counts = np.array([len(x) for x in lists], np.int64)
    flat = np.fromiter((k for x in lists for k in x), np.int64, int(counts.sum()))
    return flat, np.repeat(np.arange(len(lists)), counts)


def weighted(ids: np.ndarray, group: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``ids, group, times``: equal ids of a wide group are one, with their number."""
    plain, rest = ~wide[group], wide[group]
    if not rest.any():
        return ids, group, np.ones(len(ids), np.int64)
    key, times = np.unique(group[rest] * LEFT + ids[rest], return_counts=True)
    ids = np.r_[ids[plain], key % LEFT]
    group = np.r_[group[plain], key // LEFT]
    times = np.r_[np.ones(int(plain.sum()), np.int64), times]
    order = np.argsort(group, kind="stable")
    return ids[order], group[order], times[order]


def pair_blocks(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, doc_of: np.ndarray):
    """Yield ``doc, pair, times`` of distinct pairs, ascending: a document's pairs are all in
    one block, or, when they are many, in several of different A ids. ``ga``, ``gb``: group of
    each token, ascending from 0; ``doc_of``: document of each group, ascending."""
    groups = len(doc_of)
    wide = np.bincount(ga, minlength=groups) * np.bincount(gb, minlength=groups) > WIDE_GROUP
    a, ga, wa = weighted(a, ga, wide)
    b, gb, wb = weighted(b, gb, wide)
    nb = np.bincount(gb, minlength=groups)
    first_b = np.cumsum(nb) - nb
    made = nb[ga]  # pairs of each A token
    doc = doc_of[ga]
    order = np.lexsort((a, doc)) if made.sum() > BLOCK_PAIRS else np.arange(len(a))
    a, ga, wa, made, doc = a[order], ga[order], wa[order], made[order], doc[order]
    whole = doc if made.sum() <= BLOCK_PAIRS else doc * LEFT + a  # tokens that stay together
    total, at = np.cumsum(made), 0
    while at < len(a):
        done = int(total[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BLOCK_PAIRS, "right")))
        if to < len(a):  # cut between tokens that need not stay together
            back = int(np.searchsorted(whole, whole[to], "left"))
            to = back if back > at else int(np.searchsorted(whole, whole[at], "right"))
        of = np.repeat(np.arange(at, to), made[at:to])
        inside = np.arange(len(of)) - np.repeat(total[at:to] - made[at:to] - done, made[at:to])
        other = first_b[ga[of]] + inside
        pair, where, times = a[of] * LEFT + b[other], doc[of], wa[of] * wb[other]
        by = np.lexsort((pair, where))
        pair, where, times = pair[by], where[by], times[by]
        new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (where[1:] != where[:-1])]) if len(pair) else np.empty(0, np.int64)
        yield where[new], pair[new], np.add.reduceat(times, new) if len(new) else times
        at = to


def written_groups(codes: Codes, a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray, doc_a: np.ndarray, doc_b: np.ndarray, docs: int) -> list[str]:
    """sha256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; '' for documents without tokens."""
    last = lambda g: np.r_[g[1:] != g[:-1], True] if len(g) else np.empty(0, bool)
    per_a, per_b = (np.cumsum(np.bincount(g, minlength=1 + int(ga.max(initial=0)))) for g in (ga, gb))
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.r_[0, per_b][ga]] = a + len(codes.a) * last(ga)
    out[np.arange(len(b)) + per_a[gb]] = 2 * len(codes.a) + b + len(codes.b) * last(gb)
    strings = codes.written[out].tolist()
    ends = np.cumsum(np.bincount(doc_a, minlength=docs) + np.bincount(doc_b, minlength=docs)).tolist()
    digests, at = [], 0
    for end in ends:
        digests.append(hashlib.sha256("".join(strings[at:end])[:-1].encode()).hexdigest() if end > at else "")
        at = end
    return digests


def _aligner(a_path: str, b_path: str, by_ranks: bool):
    """The first pass: rows of documents, and rows of pair counts."""

    def align(batches):
        import pyarrow as pa

        codes = worker_state(f"alignment:{a_path}:{b_path}", lambda: Codes(a_path, b_path, by_ranks))
        schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()), ("pair", pa.int64()), ("n", pa.int64())])
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def batch(**columns):
            count = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in schema], schema=schema)

        def fold():
            pair, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([x[1] for x in held])).astype(np.int64)
            held[:] = [(pair, n)]

        def counts():
            for pair, n in held:
                for k in range(0, len(pair), 100_000):
                    yield batch(pair=pair[k : k + 100_000], n=n[k : k + 100_000])
            held.clear()

        for source in batches:
            for part in slices(source, 2):
                rows, ids, raw = part.column(0).to_pylist(), part.column(1).to_pylist(), texts_of(part, 2)
                a_lists, b_lists = codes.encode(raw)
                (a, doc_a), (b, doc_b) = joined(a_lists), joined(b_lists)
                a_last, b_last = terminals(np.cumsum(codes.a_len[a]), np.cumsum(codes.b_len[b]))
                ends = np.unique(a_last)
                ga, gb = np.searchsorted(ends, a_last), np.searchsorted(ends, b_last)
                digests = written_groups(codes, a, ga, b, gb, doc_a, doc_b, len(rows))
                count = lambda x: np.bincount(x, minlength=len(rows))
                doc_of = doc_a[ends]
                links = np.bincount(doc_of, np.bincount(ga, minlength=len(ends)) * np.bincount(gb, minlength=len(ends)), len(rows)).astype(np.int64)
                pairs, times = [b""] * len(rows), [b""] * len(rows)
                for where, pair, t in pair_blocks(a, ga, b, gb, doc_of):
                    held.append((pair, np.ones(len(pair), np.int64)))
                    if sum(len(x[0]) for x in held) > HELD_PAIRS:
                        fold()
                        if len(held[0][0]) > HELD_PAIRS // 2:
                            yield from counts()
                    cuts = np.searchsorted(where, np.arange(len(rows) + 1))
                    for k in np.unique(where).tolist():
                        block = pair[cuts[k] : cuts[k + 1]].tobytes(), t[cuts[k] : cuts[k + 1]].astype(np.int64).tobytes()
                        if pairs[k]:  # a document of several blocks has a row for each
                            yield batch(row=[rows[k]], doc_id=[ids[k]], pairs=[block[0]], times=[block[1]])
                        else:
                            pairs[k], times[k] = block
                yield batch(row=rows, doc_id=ids, n_a=count(doc_a), n_b=count(doc_b), n_groups=count(doc_of), n_links=links, groups_sha256=digests, pairs=pairs, times=times)
        if held:
            fold()
            yield from counts()

    return align


def _summer(common):
    """The second pass: sums over a document's common pairs, and rows of its other pairs."""

    def sums(batches):
        import pyarrow as pa

        pair_of, n_of, best_of = common.value  # pairs ascending, their counts, whether the highest of their A id
        names = ["row", "count_sum", "n_best", "pair", "times"]
        for source in batches:
            for part in slices(source, 1, 4_000_000):
                rows = part.column(0).to_numpy()
                pairs, times = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.int64) for k in (1, 2))
                of = np.repeat(np.arange(len(rows)), [len(x) // 8 for x in part.column(1).to_pylist()])
                at = np.minimum(np.searchsorted(pair_of, pairs), max(len(pair_of) - 1, 0))
                known = pair_of[at] == pairs if len(pair_of) else np.zeros(len(pairs), bool)
                total, best = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
                np.add.at(total, of[known], times[known] * n_of[at[known]])
                np.add.at(best, of[known], times[known] * best_of[at[known]])
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total), pa.array(best), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64())], names=names)
                for k in range(0, int((~known).sum()), 100_000):
                    s = np.flatnonzero(~known)[k : k + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(rows[of[s]]), pa.nulls(len(s), pa.int64()), pa.nulls(len(s), pa.int64()), pa.array(pairs[s]), pa.array(times[s])], names=names)

    return sums


def common_pairs(counts: DataFrame, most: int = HEAVY_PAIRS) -> DataFrame:
    """The rows of ``counts`` with at least 2^k texts, for the smallest k that leaves ``most`` rows at most."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["c"] for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}  # at most 63 rows
    least = max(sizes, default=0) + 1
    while least and sum(c for p, c in sizes.items() if p >= least - 1) <= most:
        least -= 1
    return counts.where(power >= least)


def token_alignment(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row of ``df``."""
    spark = df.sparkSession
    source = bounded_batches(df).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    landed = land(source.mapInArrow(_aligner(a_path, b_path, same_as_ranks(a_path)), SCHEMA), "alignment")
    counts = land(landed.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")), "alignment-counts")
    a_id = F.expr(f"pair div {LEFT}")
    best = F.broadcast(counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most")))  # at most a row for each id of A
    marked = land(counts.join(best, a_id == best["a"]).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-marked")
    common = common_pairs(marked, heavy_pairs)
    found = common.toArrow()  # at most heavy_pairs rows
    columns = [found.column(c).to_numpy() for c in ("pair", "n", "best")]
    order = np.argsort(columns[0])
    shared = spark.sparkContext.broadcast(tuple(x[order].astype(np.int64) for x in columns))
    texts = landed.where("pairs is not null").select("row", "pairs", "times")
    passed = land(texts.mapInArrow(_summer(shared), "row bigint, count_sum bigint, n_best bigint, pair bigint, times bigint"), "alignment-sums")
    # a pair that is not common is held by fewer texts than a common one: no hot key
    rare = passed.where("pair is not null").select("row", "pair", "times").join(marked, "pair")
    rare = rare.select("row", (F.col("times") * F.col("n")).alias("count_sum"), F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)).alias("n_best"))
    sums = passed.where("pair is null").select("row", "count_sum", "n_best").unionByName(rare).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    figures = landed.where("n_a is not null").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return figures.join(sums, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
