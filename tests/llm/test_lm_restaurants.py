from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from feedlens.llm import lm_restaurants, lm_score
from feedlens.llm.common import word_hashes

HELD = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2]
SEEN = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2]


def test_order_of_long_words_matters(spark):
    """Words of more than three bytes, in Latin and in Greek letters, are contexts."""
    rng = random.Random(4)
    for chain in (["seven", "otters", "carry", "yellow", "stones", "across", "quiet", "rivers"], ["αβγδ", "εζηθ", "ικλμ", "νξοπ", "ρστυ", "φχψω", "αγεη", "βδζθ"]):
        turned = chain[::-1]
        rows = [(i, " ".join(["of", *chain, "in"])) for i in SEEN[:60]]
        rows += [(i, " ".join(f"filler{rng.randrange(50)}" for _ in range(12))) for i in SEEN[60:90]]
        rows += [(HELD[0], " ".join(["of", *chain, "in"])), (HELD[1], " ".join(["of", *turned, "in"]))]
        got = {r.doc_id: r for r in lm_score.lm_scores(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        right, wrong = got[HELD[0]], got[HELD[1]]
        assert right.base_score == wrong.base_score or abs(right.base_score - wrong.base_score) < 1e-9
        assert right.score > wrong.score + 5
        assert right.perplexity < 2


def trained(spark, texts, grid):
    docs = spark.createDataFrame([(i, t, i % 9 == 8) for i, t in enumerate(texts)], "doc_id bigint, text string, held_out boolean").repartition(5)
    rows = lm_restaurants.encode(docs, grid).where("shard >= 0").select("chunk", "shard", "words", "contexts", "pair_word", "pair_context", "pair_n")
    shards = rows.groupBy("shard").applyInArrow(lm_restaurants.merge(grid), lm_restaurants.SHARDS).persist()
    model, letters = lm_restaurants.train(shards, grid)
    told = letters.toArrow()
    out = []
    for batch in shards.toArrow().to_batches():
        import pyarrow as pa
        import pyarrow.compute as pc

        for k in range(batch.num_rows):
            row = pa.Table.from_batches([batch.slice(k, 1)])
            out.append(lm_restaurants.Shard(row, told.filter(pc.equal(told.column("cell"), row.column("shard")[0])), model, grid, lm_score.ROUNDS + 2))
    return model, out


def test_every_preceding_word_is_a_restaurant(spark):
    """Counts, customers and probabilities of each context, against counting; far more than 32 contexts."""
    rng = random.Random(0)
    texts = [" ".join(rng.choice(["the", "of", "word", "thing", f"longword{rng.randrange(90)}"]) for _ in range(60)) for _ in range(60)] + [""]
    pairs = Counter()
    for i, t in enumerate(texts):
        w = [" start ", *t.split(), " end "]
        pairs.update(dict.fromkeys(zip(w, w[1:]), 0))
        if i % 9 != 8:
            pairs.update(zip(w, w[1:]))
    names = sorted({x for p in pairs for x in p})
    name = dict(zip(word_hashes([x.encode() for x in names]).view(np.int64).tolist(), names, strict=True))
    for grid in (1, 3):
        model, shards = trained(spark, texts, grid)
        got, mass, rest, customers, roots = Counter(), defaultdict(float), {}, {}, {}
        for s in shards:
            tables = s.tables / lm_score.SAMPLES
            assert (tables <= s.n).all() and (tables >= np.minimum(s.n, 1)).all()
            own = s.own(tables, s.context_ints[s.context])
            for w, c, n, p in zip(s.words[s.word].tolist(), s.contexts[s.context].tolist(), s.n.tolist(), own, strict=True):
                got[name[c], name[w]] = n
                mass[name[c]] += p
            rest |= dict(zip((name[c] for c in s.contexts.tolist()), s.context_nums, strict=True))
            customers |= dict(zip((name[c] for c in s.contexts.tolist()), s.context_ints.tolist(), strict=True))
            roots |= {name[w]: p for w, p, n in zip(s.words.tolist(), s.word_nums, s.word_ints, strict=True) if n}
        assert got == pairs and len(rest) > 60
        assert customers == {c: sum(n for (x, _), n in pairs.items() if x == c) for c in customers}
        whole = (sum(roots.values()) + lm_score.unseen(model)) / model["whole"]
        assert abs(whole - 1) < 1e-9
        assert all(r > 0 and abs(mass[c] + r - 1) < 1e-9 for c, r in rest.items())


def test_a_hot_context_lies_in_many_shards(spark):
    rng = random.Random(1)
    texts = [" ".join(x for _ in range(40) for x in ("the", f"w{rng.randrange(5000)}")) for _ in range(50)]
    the = word_hashes([b"the"]).view(np.int64)[0]
    _, shards = trained(spark, texts, 4)
    follow = [int((s.contexts[s.context] == the).sum()) for s in shards]
    before = [int((s.words[s.word] == the).sum()) for s in shards]
    assert max(follow) < 0.5 * sum(follow) and max(before) < 0.5 * sum(before)


def small_shard(counts: dict, model: dict, tables, stage=1):
    """One shard with the pairs of ``counts`` ((context, word) -> n), told its own totals."""
    import pyarrow as pa

    contexts, words = sorted({c for c, _ in counts}), sorted({w for _, w in counts})
    pairs = sorted(counts, key=lambda p: (words.index(p[1]), contexts.index(p[0])))
    word, context = np.array([words.index(w) for _, w in pairs]), np.array([contexts.index(c) for c, _ in pairs])
    n, t = np.array([counts[p] for p in pairs]), np.asarray(tables)
    p = lambda v: pa.array([lm_score.pack(np.asarray(v))], pa.binary())
    table = pa.table([pa.array([0], pa.int32()), p(np.arange(len(words))), p(np.arange(len(contexts))), p(np.bincount(word)), p(context), p(n)], names=["shard", "words", "contexts", "pair_word", "pair_context", "pair_n"])
    customers, places = np.bincount(word, weights=t), np.bincount(context, weights=t)
    told = lm_restaurants._letters([
        (0, lm_restaurants.TABLES, 0, lm_restaurants.NONE, t.astype(np.int64), lm_restaurants.NONE),
        (0, lm_restaurants.WORDS, 0, lm_restaurants.NONE, customers.astype(np.int64), np.minimum(customers, 1)),
        (0, lm_restaurants.PLACES, 0, lm_restaurants.NONE, places.astype(np.int64), np.zeros(len(contexts))),
    ])
    return lm_restaurants.Shard(table, told, model, 1, stage), pairs, n


def test_sweeps_follow_gibbs_one_customer_at_a_time():
    """Mean tables of each pair after three sweeps, against seating every customer alone."""
    counts = {("a", "x"): 9, ("a", "y"): 2, ("b", "x"): 5, ("b", "z"): 1, ("c", "only"): 12, ("d", "y"): 3, ("d", "z"): 7}
    model = {"d0": 0.4, "d1": 0.6, "S": 4.0, "R": 7.0, "base": 1 / 5, "N": 39}
    start = np.ones(len(counts))
    runs, sweeps = 3000, 3
    got = np.zeros(len(counts))
    for k in range(runs):
        shard, pairs, n = small_shard(counts, model, start)
        shard.random = np.random.default_rng([9, k])
        got += list(shard.sweeps(sweeps))[-1]
    rng = np.random.default_rng(8)
    words, contexts = sorted({w for _, w in pairs}), sorted({c for c, _ in pairs})
    want = np.zeros(len(counts))
    for _ in range(runs):
        t = start.copy()
        customers = {w: sum(t[i] for i, p in enumerate(pairs) if p[1] == w) for w in words}
        places = {c: sum(t[i] for i, p in enumerate(pairs) if p[0] == c) for c in contexts}
        for _ in range(sweeps):
            new = t.copy()
            for i, (c, w) in enumerate(pairs):  # the totals of other pairs are those before the sweep
                others = customers[w] - t[i]
                parent = (others - model["d0"] * min(1, others) + (lm_score.THETA + model["d0"] * model["S"]) * model["base"]) / (lm_score.THETA + model["R"])
                tables = 1
                for seated in range(1, int(n[i])):
                    a = (lm_score.THETA + model["d1"] * (places[c] - t[i] + tables)) * parent
                    tables += rng.random() < a / (a + seated - model["d1"] * tables)
                new[i] = tables
            for i, (c, w) in enumerate(pairs):
                customers[w] += new[i] - t[i]
                places[c] += new[i] - t[i]
            t = new
        want += t
    assert np.allclose(got / runs, want / runs, atol=0.12), (got / runs, want / runs)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(3)
    for v in ([], [0], [255, 0], [256], [65536, 1], [2**32, 5], [-1, 7], [2**62, -(2**62)], rng.integers(0, 2**40, 100), [0.5, -1.25], [3.0, 7.0], [float("inf"), 1.0]):
        v = np.array(v) if len(v) else np.empty(0, np.int64)
        assert np.array_equal(lm_score.unpack(lm_score.pack(v)), v)
    assert np.allclose(lm_score.unpack(lm_score.pack(np.array([-3.5, 0.1], np.float32))), [-3.5, 0.1])
    assert len(lm_score.pack(np.ones(100, np.int64))) == 101


def test_last_letters_are_whole_numbers(spark):
    """What stays on disk for the answers: counts of words and contexts, no eight-byte fractions."""
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(400)}" for _ in range(50)), False) for i in range(60)], "doc_id bigint, text string, held_out boolean")
    rows = lm_restaurants.encode(docs, 2).where("shard >= 0").select("chunk", "shard", "words", "contexts", "pair_word", "pair_context", "pair_n")
    _, letters = lm_restaurants.train(rows.groupBy("shard").applyInArrow(lm_restaurants.merge(2), lm_restaurants.SHARDS).persist(), 2)
    got = letters.collect()
    assert {r.kind for r in got} == {lm_restaurants.WORDS, lm_restaurants.PLACES, lm_restaurants.TABLES}
    assert all(r.nums[0] != lm_score.KINDS.index("<f8") and r.ints[0] <= lm_score.KINDS.index("<u2") for r in got)


def test_questions_of_a_chunk_ascend(spark):
    """Each chunk names its pairs in the merged order, so small steps are kept."""
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(300)}" for _ in range(40)), i % 5 == 0) for i in range(80)], "doc_id bigint, text string, held_out boolean").repartition(4)
    rows = lm_restaurants.encode(docs, 3).where("shard >= 0").select("chunk", "shard", "words", "contexts", "pair_word", "pair_context", "pair_n")
    merged = rows.groupBy("shard").applyInArrow(lm_restaurants.merge(3), lm_restaurants.SHARDS).collect()
    assert len(merged) > 1
    for r in merged:
        ends = np.cumsum(lm_score.unpack(r.asked_n))[:-1]
        n_pairs = len(lm_score.unpack(r.pair_n))
        for steps in np.split(lm_score.unpack(r.asked), ends):
            assert (steps[1:] > 0).all() and steps.sum() < n_pairs
