"""Near-duplicate detection with SetSketch registers.

A document's set holds its distinct 4-word shingles (its whole word sequence if it has fewer
words), hashed to 64 bits. Two documents are linked if 100 * |intersection| >= 80 * |union|;
a document's component is the smallest id reachable through links.

1. Each text gives one row: set size, a 128-bit digest of the set, and ``REGISTERS`` SetSketch
   registers: the smallest of the set's exponential variables under each hash, truncated to a
   16-bit step on an exponential scale of base ``BASE``. The register of a union is the
   maximum of the registers, and registers of similar sets are often equal.
2. Equal sets (same digest) are one class with a number of its own; from here on classes are
   compared, not ids. Classes that share an id are linked.
3. Bands of ``BAND`` register values are bucket keys. Of two sets with similarity 0.8 or more,
   all 32 bands differ with probability below 5e-8.
4. Every bucket has a pivot, its member with the most company over all its buckets. Members
   are compared with their pivots only: the maximum-likelihood similarity, from how many
   registers are equal, larger and smaller, rules out what is far off (``FAR_OFF``, six
   standard errors), the full sets decide.
5. Buckets whose members are then all in one component are done. In the others the pairs
   across components are searched without writing them all down. Each open document x has a
   home pivot p; with a = |x & p| and E = those of x's shingles outside p that some other
   open document of that home has, two documents of one home share at most
   ``min(a, a') + |E & E'|`` shingles, and documents with ``a + |E|`` too small for any mate
   need no look. Pairs for which this is too few are never formed; the others, and pairs
   with different homes, are compared as in step 4. So no link between bucket mates is
   lost, and a large group of copies costs about its size, not its square.
6. Components by star contraction, named by the smallest id of their classes.

Shuffles move ids, keys and registers; full sets move for bucket mates only. Texts are read
twice. Hot keys meet in plain joins (split by adaptive execution) and map-side aggregates.

Defined cases: null and empty texts, and texts of white space, have empty sets and are linked
with nothing; a row with a null id is kept, has no component and links nothing; rows that
repeat an id, with equal or different texts, are one document (their texts' links are joined);
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, bounded_broadcast, land, mix, slices, texts_of, word_hashes
from feedlens.llm.components import components

SHINGLE = 4
#: Bands take the first ``BANDS * BAND`` registers, likelihood estimates all of them.
BANDS, BAND = 32, 4
REGISTERS = 256
#: Base of the registers' scale, its last step, and the rate of the exponential variables.
BASE, STEPS, RATE = 1.001, 65534, 20.0
#: Likelihood estimates below this are six standard errors from 0.8.
FAR_OFF = 0.65
SEED = 5


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one text after another, and how many each has."""
    split = [t.lower().split() for t in texts]  # bytes: A-Z only
    n = np.array([len(w) for w in split], dtype=np.int64)
    h = word_hashes([w for words in split for w in words])
    keys = np.random.default_rng(SEED).integers(1, 2**63, 2 * SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    starts = np.cumsum(n) - n
    wide = np.empty(0, np.uint64)
    if len(h) >= SHINGLE:
        wide = h[: len(h) - SHINGLE + 1] * keys[0]
        for j in range(1, SHINGLE):
            wide = mix(wide) + h[j : len(h) - SHINGLE + 1 + j] * keys[j]
        wide = mix(wide)
    parts = []
    for at, k in zip(starts.tolist(), n.tolist(), strict=True):
        if k >= SHINGLE:
            parts.append(np.unique(wide[at : at + k - SHINGLE + 1]))
        elif k:
            one = keys[SHINGLE : SHINGLE + 1] * np.uint64(k)
            for j in range(k):
                one = mix(one) + h[at + j : at + j + 1] * keys[j]
            parts.append(mix(one))
        else:
            parts.append(np.empty(0, np.uint64))
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.array([len(p) for p in parts], dtype=np.int64)


def registers(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """SetSketch registers (16 bits) of each set; empty sets have all zero."""
    out = np.zeros((len(sizes), REGISTERS), dtype=np.uint16)
    full = sizes > 0
    if not full.any():
        return out
    starts = (np.cumsum(sizes) - sizes)[full]
    random = np.random.default_rng([SEED, 1])
    flip = random.integers(0, 2**63, REGISTERS, dtype=np.uint64)
    factor = random.integers(1, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.stack([np.minimum.reduceat((hashes ^ flip[j]) * factor[j], starts) for j in range(REGISTERS)], 1)
    # the smallest of the set's exponential variables is that of its smallest uniform one
    smallest = -np.log1p(-np.minimum((least.astype(np.float64) + 0.5) / 2.0**64, 1 - 1e-16)) / RATE
    step = np.floor(1 - np.log(smallest) / np.log(BASE))
    out[full] = np.clip(step, 0, STEPS + 1).astype(np.uint16)
    return out


def likely_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sets with ``n_a`` and ``n_b`` elements from their
    registers (rows of ``a`` and ``b``): golden-section search of the joint likelihood of the
    numbers of larger, smaller and equal registers."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def value(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny)) + same * np.log(np.maximum(1 - up - down, tiny))

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(30):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        better = value(left) >= value(right)
        high, low = np.where(better, right, high), np.where(better, low, left)
    return (low + high) / 2


def _chosen(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")


def digests(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of each set's digest."""
    both = [(int(mix(x).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(x * np.uint64(0x9E3779B97F4A7C15))))) if len(x) else (0, 0) for x in np.split(hashes, np.cumsum(sizes)[:-1])]
    lo, hi = (np.array(x, dtype=np.uint64).view(np.int64) for x in zip(*both, strict=True))
    return lo, hi


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, n, lo, hi, regs`` for each row of ``docs(doc_id, text)``."""

    def sign(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                h, n = shingles(texts_of(part))
                lo, hi = digests(h, n)
                regs = [r.tobytes() for r in registers(h, n).astype("<u2")]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(lo), pa.array(hi), pa.array(regs, pa.binary())], names=["doc_id", "n", "lo", "hi", "regs"])

    return docs.mapInArrow(sign, "doc_id bigint, n bigint, lo bigint, hi bigint, regs binary")


def full_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n, lo, hi, set`` (ascending 64-bit hashes) for each row of ``docs(doc_id, text)``."""

    def collect(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                h, n = shingles(texts_of(part))
                lo, hi = digests(h, n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(lo), pa.array(hi), pa.array([x.tobytes() for x in np.split(h, np.cumsum(n)[:-1])], pa.binary())], names=["doc_id", "n", "lo", "hi", "set"])

    return docs.mapInArrow(collect, "doc_id bigint, n bigint, lo bigint, hi bigint, set binary")


def _beside(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """``pairs(a, b, ...)`` with ``columns`` of ``table(doc_id, ...)`` for both, as ``column_a`` and ``column_b``."""
    for side in ("a", "b"):
        own = table.select(F.col("doc_id").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs


def linked(pairs: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among ``pairs(a, b)``: likelihood first, then the full sets."""

    def near(batches):
        import pyarrow as pa

        for batch in batches:
            regs = [np.frombuffer(b"".join(batch.column(f"regs_{s}").to_pylist()), "<u2").reshape(batch.num_rows, -1) for s in "ab"]
            sizes = [batch.column(f"n_{s}").to_numpy().astype(float) for s in "ab"]
            keep = likely_similarity(*regs, *sizes) >= FAR_OFF if batch.num_rows else np.empty(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.intersect1d(x, y, assume_unique=True).size
                out.append(100 * both >= 80 * (x.size + y.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

    # a size ratio below 0.8 rules a link out
    sized = _beside(pairs, reps, "n", "regs").where("5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b)")
    estimated = sized.select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(near, "a bigint, b bigint")
    return _beside(land(estimated, "candidates"), sets, "set").select("a", "b", "set_a", "set_b").mapInArrow(verify, "a bigint, b bigint")


def _outside(batches):
    """What each document shares with its home, and its shingles outside it."""
    import pyarrow as pa

    for batch in batches:
        shared, outside = [], []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            out = x[~np.isin(x, y, assume_unique=True)]
            shared.append(x.size - out.size)
            outside.append(out)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(outside, pa.list_(pa.int64()))], names=["doc_id", "home", "shared", "outside"])


def open_pairs(open_members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` across components in ``open_members(key, doc_id, n, comp, pivot, pivot_company)``
    that the bound of step 5 does not rule out."""
    best = F.max(F.struct("pivot_company", (-F.col("pivot")).alias("least"))).alias("best")
    of = open_members.groupBy("doc_id", "n", "comp").agg(best, F.collect_set("key").alias("keys"))
    of = land(of.select("doc_id", "n", "comp", (-F.col("best.least")).alias("home"), "keys"), "open")
    compared = _beside(of.select(F.col("doc_id").alias("a"), F.col("home").alias("b")), sets, "set").select("a", "b", "set_a", "set_b")
    told = land(compared.mapInArrow(_outside, "doc_id bigint, home bigint, shared bigint, outside array<bigint>"), "outside")
    apart = told.select("doc_id", "home", F.explode("outside").alias("s"))
    common = apart.groupBy("home", "s").agg(F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    extra = apart.join(common, ["home", "s"]).groupBy("doc_id").agg(F.collect_list("s").alias("extra"))
    known = of.join(told.groupBy("doc_id").agg(F.max("shared").alias("shared")), "doc_id").join(extra, "doc_id", "left")
    known = known.withColumn("extra", F.coalesce("extra", F.array().cast("array<bigint>")))
    placed = land(open_members.select("key", "doc_id").distinct().join(known, "doc_id"), "placed")

    def cross(rows: DataFrame, on: list[str], more: str) -> DataFrame:
        names = [c for c in rows.columns if c not in on]
        left = rows.select(*on, *(F.col(c).alias(f"{c}_a") for c in names))
        right = rows.select(*on, *(F.col(c).alias(f"{c}_b") for c in names))
        # a pair that meets in several buckets is formed in the first of them only
        first = "key = array_min(array_intersect(keys_a, keys_b))"
        fits = f"doc_id_a < doc_id_b and comp_a <> comp_b and 5 * least(n_a, n_b) >= 4 * greatest(n_a, n_b) and {more} and {first}"
        right = right.withColumnsRenamed({c: f"{c}_r" for c in on})
        return left.join(right, F.expr(" and ".join(f"{c} = {c}_r" for c in on) + f" and {fits}")).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))

    group = placed.groupBy("key", "home").agg(F.min("n").alias("least_n"))
    able = placed.join(group, ["key", "home"]).where("9 * (shared + size(extra)) >= 4 * (n + least_n)").drop("least_n")
    enough = "9 * (least(shared_a, shared_b) + {}) >= 4 * (n_a + n_b)"
    cheap, exact = enough.format("least(size(extra_a), size(extra_b))"), enough.format("size(array_intersect(extra_a, extra_b))")
    alike = cross(able, ["key", "home"], f"{cheap} and {exact}")
    several = group.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    other = cross(placed.join(several, "key", "left_semi").drop("extra", "shared"), ["key"], "home_a <> home_b")
    return alike.unionByName(other).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    docs = _chosen(df, id_col, text_col)
    signed = land(signatures(docs), "signatures")
    # an empty set is a class of its id alone
    named = signed.where("doc_id is not null").withColumn("alone", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.lit(0)))
    key = ["n", "lo", "hi", "alone"]
    classes = named.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("regs").alias("regs"))
    classes = land(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    mapped = land(named.drop("regs").join(classes.drop("regs"), key).select("doc_id", "n", "rep", "node"), "mapped")
    # below, doc_id is the number of a class
    reps = classes.where("n > 0").select(F.col("node").alias("doc_id"), "n", "regs")
    several = mapped.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("_most")).where("b <> _most").drop("_most")
    same_id = mapped.join(bounded_broadcast(land(several, "several")), "doc_id").where("node <> b").select(F.col("node").alias("a"), "b").distinct()

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring(F.col("regs"), i * (2 * BAND) + 1, F.lit(2 * BAND))))
    banded = reps.select("doc_id", "n", F.explode(band).alias("key"))
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    members = land(banded.join(sizes, "key"), "members")
    company = members.groupBy("doc_id").agg(F.sum("mates").alias("company"))
    met = members.select("key", "doc_id", "n").join(company, "doc_id")
    pivots = met.groupBy("key").agg(F.max(F.struct("company", (-F.col("doc_id")).alias("least"))).alias("p"))
    pivots = pivots.select("key", (-F.col("p.least")).alias("pivot"), F.col("p.company").alias("pivot_company"))
    met = land(met.join(pivots, "key").select("key", "doc_id", "n", "pivot", "pivot_company"), "met")

    mates = met.select(F.col("doc_id").alias("node")).distinct().join(classes.drop("regs", "alone"), "node").withColumnRenamed("rep", "doc_id")
    mates = land(mates, "mates")
    read = full_sets(docs.join(bounded_broadcast(mates.select("doc_id").distinct()), "doc_id", "left_semi"))
    sets = read.join(bounded_broadcast(mates), ["doc_id", "n", "lo", "hi"]).select(F.col("node").alias("doc_id"), "set")
    sets = land(sets, "sets").dropDuplicates(["doc_id"])
    pairs = met.where("doc_id <> pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()
    links = land(linked(pairs, reps, sets).unionByName(same_id), "links")
    parts = components(links)

    at = met.join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    still = at.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    open_members = land(at.join(still, "key", "left_semi"), "open")
    if not open_members.isEmpty():
        late = land(linked(open_pairs(open_members, sets), reps, sets), "late")
        if not late.isEmpty():
            parts = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late))

    grouped = parts.unionByName(parts.select(F.col("component").alias("node"), "component").distinct())
    least = land(grouped.join(classes.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("least")), "least")
    found = mapped.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")).join(bounded_broadcast(least), "component", "left")
    found = found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "rep").alias("component_id"))
    unnamed = signed.where("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.unionByName(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose document stays, with all their columns."""
    dropped = land(near_duplicates(df, id_col, text_col).where("not kept").select(F.col("doc_id").alias("_dropped")).distinct(), "dropped")
    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"), F.col(id_col).cast("bigint").alias("_doc"))
    return packed.join(bounded_broadcast(dropped), F.col("_doc") == F.col("_dropped"), "left_anti").select("row.*")
