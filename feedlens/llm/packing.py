"""Packing documents into sequences by the linear grouping scheme.

Lengths are whole numbers of at most ``capacity`` tokens, so the histogram of lengths (at most
``capacity`` rows however large the input) holds all that the plan needs. On the driver:

1. *Large* lengths (over ``capacity / LARGE``) are put in order and cut into groups of equal
   cardinality; each is rounded up to the largest of its group.
2. The few sizes left give a configuration problem, solved by column generation: a revised
   simplex over configurations, new ones found by an unbounded knapsack. Counts are rounded down.
3. Actual lengths take the places of the rounded ones.
4. What is left, and all small lengths, go by best fit, longest first, into the sequence with
   the least room that holds them; a new sequence opens only if none does.

Few groups waste more room by rounding, many leave less of it for small lengths: the numbers
of groups in ``GROUPS`` are tried in turn until a plan is within ``NEAR`` of the lower bound,
and the shortest plan counts.

The plan is a list of runs: the documents of one length with ranks r0, r0+1, ... go to
consecutive sequences at one offset. Documents are ranked among those of their length by a
distributed running count (any share of them may have one length) and find their run by
binary search; no document passes through the driver.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, land, running, slices, texts_of
from feedlens.llm.word_ids import encoder

CAPACITY = 4096
#: A length is large if it is over capacity / LARGE. Numbers of groups to try, and when to stop.
LARGE, GROUPS, NEAR = 8, (12, 24, 48, 96), 1.001
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


@dataclass
class Bins:
    """``count`` sequences filled alike: items are (length, copies in each)."""

    count: int
    items: list[tuple[int, int]] = field(default_factory=list)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations (items of each size) and how often each is used, by column generation;
    use counts are rounded down, so the demand is met in part."""
    k = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(50 * k):
        inverse = np.linalg.inv(basis)
        use = inverse @ demand
        price = np.ones(k) @ inverse
        # the best configuration at these prices: a knapsack in as many rounds as items can fit
        best, last, before = np.zeros(capacity + 1), [], None
        useful = np.flatnonzero(price > 1e-12)
        for _ in range(capacity // int(sizes.min())):
            before, pick = best, np.full(capacity + 1, -1)
            best = before.copy()
            for item in useful:
                size = int(sizes[item])
                value = before[:-size] + price[item]
                more = value > best[size:] + 1e-12
                best[size:][more], pick[size:][more] = value[more], item
            last.append(pick)
            if (pick < 0).all():
                break
        c = int(best.argmax())
        if best[c] <= 1 + 1e-7:
            break
        column = np.zeros(k)
        for pick in reversed(last):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= int(sizes[pick[c]])
        direction = inverse @ column
        grows = direction > 1e-9
        if not grows.any():
            break
        ratio = np.full(k, np.inf)
        ratio[grows] = use[grows] / direction[grows]
        basis[:, int(ratio.argmin())] = column
    use = np.linalg.solve(basis, demand)
    return [(basis[:, j].astype(np.int64), int(np.floor(use[j] + 1e-9))) for j in range(k) if use[j] >= 1]


def plan_large(counts: dict[int, int], capacity: int, groups: int) -> list[Bins]:
    """Steps 1 to 3 for the large lengths in ``counts``, which loses what is placed."""
    lengths = sorted(counts, reverse=True)
    total = sum(counts.values())
    if not total:
        return []
    each = -(-total // groups)
    members: list[list[list[int]]] = [[]]  # of each group: [length, count], descending
    room = each
    for length in lengths:
        left = counts[length]
        while left:
            if not room:
                members.append([])
                room = each
            take = min(left, room)
            members[-1].append([length, take])
            left, room = left - take, room - take
    by_size: dict[int, list[list[int]]] = {}
    for group in members:
        by_size.setdefault(group[0][0], []).extend(group)
    sizes = np.array(sorted(by_size, reverse=True))
    demand = np.array([sum(n for _, n in by_size[s]) for s in sizes], dtype=float)
    placed = []
    for column, use in configurations(sizes, demand, capacity):
        slots = [int(s) for s, a in zip(sizes, column, strict=True) for _ in range(a)]
        while use:
            # as many alike sequences as the next actual length of every slot allows
            queue: dict[int, int] = {}
            for s in slots:
                queue[s] = queue.get(s, 0) + 1
            take, items = use, []
            for s, copies in queue.items():
                have = by_size[s]
                if have:
                    fit = min(copies, have[0][1])
                    items.append((s, have[0][0], fit))
                    take = min(take, have[0][1] // fit)
            if not items:
                break
            for s, length, fit in items:
                by_size[s][0][1] -= fit * take
                counts[length] -= fit * take
                if not by_size[s][0][1]:
                    by_size[s].pop(0)
            placed.append(Bins(take, [(length, fit) for _, length, fit in items]))
            use -= take
    return placed


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large: int = LARGE, groups: tuple[int, ...] = GROUPS) -> list[Bins]:
    """Sequences for ``histogram`` (length to count): every item placed, none over ``capacity``."""
    counts = {int(k): int(v) for k, v in histogram.items() if v > 0}
    if counts and (min(counts) < 1 or max(counts) > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    bound = max(-(-sum(k * v for k, v in counts.items()) // capacity), sum(v for k, v in counts.items() if 2 * k > capacity))
    best: list[Bins] | None = None
    for g in groups:
        found = plan_with(dict(counts), capacity, large, g)
        if best is None or sum(b.count for b in found) < sum(b.count for b in best):
            best = found
        if sum(b.count for b in best) <= NEAR * bound:
            break
    return best or []


def plan_with(counts: dict[int, int], capacity: int, large: int, groups: int) -> list[Bins]:
    """The plan with one number of groups."""
    done = [Bins(counts.pop(capacity), [(capacity, 1)])] if capacity in counts else []
    big = {k: v for k, v in counts.items() if k > capacity // large}
    open_bins: dict[int, list[Bins]] = {}

    def put(bins: Bins) -> None:
        room = capacity - sum(length * copies for length, copies in bins.items)
        if room:
            if room not in open_bins:
                bisect.insort(rooms, room)
            open_bins.setdefault(room, []).append(bins)
        else:
            done.append(bins)

    rooms: list[int] = []
    for bins in plan_large(big, capacity, groups):
        put(bins)
    counts.update(big)
    for length in sorted((k for k, v in counts.items() if v), reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                copies = min(capacity // length, left)
                put(Bins(left // copies, [(length, copies)]))
                left %= copies
                continue
            room = rooms[at]
            bins = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
            copies = min(room // length, left)
            take = min(bins.count, left // copies)
            if take < bins.count:
                put(Bins(bins.count - take, bins.items))
            put(Bins(take, [*bins.items, (length, copies)]))
            left -= take * copies
    return done + [b for room in rooms for b in open_bins[room]]


def runs(bins: list[Bins]) -> dict[str, np.ndarray]:
    """The plan by (length, first rank): where the run's documents go. A run's documents fill
    ``copies`` places, one after another, in each of its sequences."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for b in bins:
        offset = 0
        for length, copies in b.items:
            first = rank.get(length, 0)
            rows.append((length, first, copies, sequence, offset))
            rank[length] = first + b.count * copies
            offset += length * copies
        sequence += b.count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T, strict=True))


def pack(pieces: DataFrame, tie: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (landed, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and
    ``offset``. ``tie`` orders pieces of one length, so that reruns agree."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    table = runs(plan(histogram, capacity))
    columns = pieces.columns
    ranked = running(pieces, ["length", *tie], F.lit(1), ["length"], "ranked")

    def place(batches):
        import pyarrow as pa

        keys = np.stack([table["length"], table["first"]], 1) if len(table["length"]) else np.empty((0, 2), np.int64)
        first_run = {int(x): int(np.searchsorted(keys[:, 0], x)) for x in np.unique(keys[:, 0])}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("before").to_numpy()
            at = np.empty(len(length), np.int64)
            for x in np.unique(length):
                here = length == x
                lo = first_run[int(x)]
                hi = int(np.searchsorted(keys[:, 0], x, "right"))
                at[here] = lo + np.searchsorted(keys[lo:hi, 1], rank[here], "right") - 1
            inside = rank - table["first"][at]
            sequence = table["sequence"][at] + inside // table["copies"][at]
            offset = table["offset"][at] + inside % table["copies"][at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    schema = pieces.select(*columns, F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema
    return ranked.select(*columns, "before").mapInArrow(place, schema)


def token_pieces(df: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: each text's ids and the end id, cut only if longer
    than ``capacity``. A null or empty text is the end id alone."""
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        import pyarrow as pa

        ids_of = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), ids_of.encode(texts_of(part)), strict=True):
                    ids += end
                    rows += [(doc_id, k, k * capacity, ids[4 * k * capacity : 4 * (k + 1) * capacity]) for k in range(-(-len(ids) // (4 * capacity)))]
                d, p, s, x = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(p, pa.int32()), pa.array(s, pa.int64()), pa.array([len(i) // 4 for i in x], pa.int64()), pa.array(x, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

    return bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(cut, PIECES)


def pack_documents(df: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Defined cases: null and empty texts are one piece of one token; null ids and repeated rows
    are packed like any other; an empty table gives no rows; further columns are ignored.
    """
    pieces = land(token_pieces(df, tokenizer, end_id, capacity).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], capacity)
