"""The word-pair model behind ``lm_score``: a restaurant for each word that precedes another.

A token's context is the word right before it (a text's first token has a context of its own),
named by its 64-bit hash, so the number of restaurants grows with the corpus. The distinct
(context, word) pairs of a chunk are counted there and go to the *shards* of a grid: a word's
hash chooses the row, a context's hash the column. So neither a hot word nor a hot context is
ever in one place; its pairs lie in a whole row or column.

What a restaurant or a word has in all shards is summed by *letters*: each shard sends, for its
words and contexts, sums over its own pairs to the grid cell that keeps them (a word's cell lies
in the word's row, a context's in its column); that cell adds them up, seats the root and answers
every sender in the sender's order. Between letters a shard adds its own changes to the totals it
was told. The driver only sees sums over all cells.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm import lm_score as lm
from feedlens.llm.common import land, mix, slices, texts_of, word_hashes

ENCODED = "chunk bigint, shard int, words binary, contexts binary, pair_word binary, pair_context binary, pair_n binary, doc_id bigint, held_out boolean, tokens binary"
SHARDS = "shard int, words binary, contexts binary, pair_word binary, pair_context binary, pair_n binary, chunks binary, asked_n binary, asked binary"
LETTERS = "cell int, kind int, source int, keys binary, ints binary, nums binary"
#: Kinds of letters: about words, about contexts, a shard's own tables, sums for the driver.
WORDS, PLACES, TABLES, SUMS = range(4)
#: Numbers that a cell sends to the driver.
SUMMED = 4 + max(4, lm.SAMPLES)


def side(shards: int) -> int:
    """Rows (and columns) of a grid with at least ``shards`` cells."""
    return math.isqrt(max(1, shards) - 1) + 1


def lines(hashes: np.ndarray, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """The row (of a word) or column (of a context), and the keeper's place on it."""
    h = mix(hashes.view(np.uint64))
    return (h % np.uint64(grid)).astype(np.int64), ((h >> np.uint64(32)) % np.uint64(grid)).astype(np.int64)


def _packed(values: list):
    import pyarrow as pa

    return pa.array([lm.pack(v) for v in values], pa.binary())


def encode(docs: DataFrame, grid: int) -> DataFrame:
    """Rows of ``docs(doc_id, text, held_out)`` as chunks: a row for each document (its pair
    numbers) and for each shard (pairs with their training counts)."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        start, end = word_hashes([b" start ", b" end "])  # no word holds a space
        number, held, size = TaskContext.get().partitionId() << 24, [], 0

        def flush():
            nonlocal number, held, size
            ids, outs, hashes, lengths = zip(*held, strict=True)
            held, size = [], 0
            lengths, outs = np.concatenate(lengths), np.concatenate(outs)
            training = np.repeat(~outs, lengths)
            ends = np.r_[0, np.cumsum(lengths)]
            words, number_of = np.unique(np.concatenate([*hashes, np.array([start])]), return_inverse=True)
            del hashes
            first, number_of = number_of[-1], number_of[:-1]
            before = np.r_[first, number_of[:-1]]
            before[ends[:-1]] = first
            pairs, tokens = np.unique(before * len(words) + number_of, return_inverse=True)
            del before, number_of
            n = np.bincount(tokens[training], minlength=len(pairs)).astype(np.int64)
            context, word = np.divmod(pairs, len(words))
            line, keeper = lines(words, grid)
            shard = line[word] * grid + line[context]
            by_rank = np.lexsort((words.view(np.int64), keeper))  # the order of a merged shard
            rank = np.empty(len(words), np.int64)
            rank[by_rank] = np.arange(len(words))
            context, word = rank[context], rank[word]
            order = np.lexsort((context, word, shard))
            place = np.empty(len(pairs), np.int32)
            place[order] = np.arange(len(pairs), dtype=np.int32)
            tokens = place[tokens]
            shard, word, context, n = shard[order], word[order], context[order], n[order]
            cuts = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)]
            names_of, places_of, per_word, pair_context, counts = [], [], [], [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                known, per = np.unique(word[a:b], return_counts=True)  # the pairs are in the order of words
                names_of.append(words[by_rank[known]].view(np.int64))
                per_word.append(per)
                known, inside = np.unique(context[a:b], return_inverse=True)
                places_of.append(words[by_rank[known]].view(np.int64))
                pair_context.append(inside)
                counts.append(n[a:b])
            k, d = len(cuts) - 1, len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(k, number)), pa.array(shard[cuts[:-1]], pa.int32()), *map(_packed, (names_of, places_of, per_word, pair_context, counts)),
                    pa.nulls(k, pa.int64()), pa.nulls(k, pa.bool_()), pa.nulls(k, pa.binary()),
                ],
                names=names,
            )
            nothing = [pa.nulls(d, pa.binary())] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(d, number)), pa.array(np.full(d, -1), pa.int32()), *nothing, pa.chunked_array(ids, pa.int64()).combine_chunks(), pa.array(outs),
                    _packed(np.split(tokens, ends[1:-1])),
                ],
                names=names,
            )
            number += 1

        for batch in batches:
            for part in slices(batch):
                texts = texts_of(part)
                split = [t.lower().split() for t in texts]
                lengths = np.array([len(w) for w in split], dtype=np.int64) + 1
                last = np.cumsum(lengths) - 1
                is_word = np.ones(int(lengths.sum()), bool)
                is_word[last] = False
                hashes = np.empty(len(is_word), np.uint64)
                hashes[is_word], hashes[last] = word_hashes([w for words in split for w in words]), end
                held.append((part.column(0), part.column(2).to_numpy(zero_copy_only=False).astype(bool), hashes, lengths))
                size += sum(map(len, texts))
                if size >= lm.CHUNK_BYTES:
                    yield from flush()
        if held:
            yield from flush()

    names = [c.split()[0] for c in ENCODED.split(", ")]
    return docs.mapInArrow(run, ENCODED)


def merge(grid: int):
    """For one shard: its pairs with their training counts over all chunks (none for a pair that
    only held-out texts have), and where each chunk's pairs are among them: they ascend, so the
    steps between them are kept."""

    def run(table):
        import pyarrow as pa

        def unified(names, at, n_pairs):
            hashes, n = lm.unpacked(table.column(names))
            known, inside = np.unique(hashes, return_inverse=True)
            order = np.argsort(lines(known, grid)[1], kind="stable")  # by keeper
            place = np.empty(len(known), np.int64)
            place[order] = np.arange(len(known))
            return known[order], place[inside[np.repeat(np.cumsum(n) - n, n_pairs) + at]]

        per_word, n_words = lm.unpacked(table.column("pair_word"))
        pair_context, n_pairs = lm.unpacked(table.column("pair_context"))
        within = np.arange(len(per_word)) - np.repeat(np.cumsum(n_words) - n_words, n_words)
        words, word = unified("words", np.repeat(within, per_word), n_pairs)
        contexts, context = unified("contexts", pair_context, n_pairs)
        pairs, asked = np.unique(word * len(contexts) + context, return_inverse=True)
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, asked, lm.unpacked(table.column("pair_n"))[0])
        word, context = np.divmod(pairs, len(contexts))
        steps = np.diff(asked, prepend=0)
        first = np.cumsum(n_pairs) - n_pairs
        steps[first] = asked[first]
        values = [words, contexts, np.bincount(word, minlength=len(words)), context, n, table.column("chunk").to_numpy(), n_pairs, steps]
        return pa.table([pa.array([table.column("shard")[0].as_py()], pa.int32()), *(_packed([v]) for v in values)], names=[c.split()[0] for c in SHARDS.split(", ")])

    return run


def _letters(rows: list[tuple]):
    """A table of letters."""
    import pyarrow as pa

    cells, kinds, sources, keys, ints, nums = zip(*rows, strict=True) if rows else [()] * 6
    flat = [pa.array(x, pa.int32()) for x in (cells, kinds, sources)]
    return pa.table([*flat, *map(_packed, (keys, ints, nums))], names=[c.split()[0] for c in LETTERS.split(", ")])


def _sorted(table, kind: int):
    """The letters of one kind, by sender."""
    import pyarrow.compute as pc

    return table.filter(pc.equal(table.column("kind"), kind)).sort_by("source").combine_chunks()


def _columns(column, sizes: np.ndarray) -> list[np.ndarray]:
    """Letters hold several arrays after another, each of ``sizes`` values: each array over all letters."""
    values, lengths = lm.unpacked(column)
    if not len(sizes) or not lengths.sum():
        return [np.zeros(0)]
    per = int(lengths[np.argmax(sizes)] // sizes.max())
    at = np.cumsum(lengths) - lengths
    first = np.repeat(at - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return [values[first + j * np.repeat(sizes, sizes)].astype(float) for j in range(per)]


NONE = np.empty(0, np.int64)


class Shard:
    """The pairs of one shard, the tables they have, and what it was told of its words and contexts."""

    def __init__(self, table, told, model: dict, grid: int, stage: int):
        self.shard, self.grid, self.m = table.column("shard")[0].as_py(), grid, model
        self.words, self.contexts, per_word, self.context, self.n = (lm.unpacked(table.column(c))[0] for c in ("words", "contexts", "pair_word", "pair_context", "pair_n"))
        self.word = np.repeat(np.arange(len(self.words)), per_word)
        self.random = np.random.default_rng([lm.SEED, self.shard, stage])
        self.tables = np.minimum(self.n, 1).astype(float)
        if stage:
            self.tables = lm.unpacked(_sorted(told, TABLES).column("ints"))[0].astype(float)
            about = {k: _sorted(told, k) for k in (WORDS, PLACES)}
            if stage > lm.ROUNDS + 1:
                self.sampled(about)
                return
            self.word_ints, self.context_ints = (lm.unpacked(about[k].column("ints"))[0] for k in (WORDS, PLACES))
            self.word_nums, self.context_nums = (_columns(about[k].column("nums"), lm.unpacked(about[k].column("ints"))[1])[0] for k in (WORDS, PLACES))

    def sampled(self, about):
        """After the last letters: each word's count and its probability in the root, each
        context's customers and what it leaves to the root, in every sample and on average."""
        m = self.m
        (count, *seats), (customers, *tables) = (
            _columns(about[k].column("ints"), lm.unpacked(about[k].column("ints"))[1] // per) for k, per in ((WORDS, 1 + 2 * lm.SAMPLES), (PLACES, 1 + lm.SAMPLES))
        )
        self.word_ints, self.context_ints = count.astype(np.int64), customers.astype(np.int64)
        self.word_samples = [root(m, c, t) for c, t in zip(seats[: lm.SAMPLES], seats[lm.SAMPLES :], strict=True)]
        self.context_samples = [1 - (customers - m["d1"] * t) / (lm.THETA + customers) for t in tables]
        self.word_nums, self.context_nums = sum(self.word_samples) / lm.SAMPLES, sum(self.context_samples) / lm.SAMPLES

    def of_words(self, values):
        return np.bincount(self.word, weights=values, minlength=len(self.words))

    def of_contexts(self, values):
        return np.bincount(self.context, weights=values, minlength=len(self.contexts))

    def sweeps(self, times: int):
        """Seat all pairs again, ``times`` times; the tables after each sweep. Told: customers and
        tables of each word in the root, tables of each context."""
        m, n = self.m, self.n.astype(float)
        customers, root_tables, tables = self.word_ints.astype(float), self.word_nums, self.context_ints.astype(float)
        for _ in range(times):
            was = self.tables
            others = np.maximum(customers[self.word] - was, 0)  # without this pair's own tables
            parent = root(m, others, np.minimum(root_tables[self.word], others))
            left = np.maximum(tables[self.context] - was, 0)  # the restaurant's tables while these customers are out
            self.tables = lm.reseat(n, (lm.THETA + m["d1"] * left) * parent, m["d1"], self.random, m["d1"] * parent)
            customers = customers + self.of_words(self.tables - was)
            tables = tables + self.of_contexts(self.tables - was)
            yield self.tables

    def own(self, tables, customers):
        """What a context with so many customers gives to each of its words itself."""
        return np.maximum(self.n - self.m["d1"] * tables, 0) / (lm.THETA + customers)

    def letters(self, kind: int, ints: list[np.ndarray]):
        """To every keeper, the values of its words or contexts."""
        keys = self.words if kind == WORDS else self.contexts
        keeper = lines(keys, self.grid)[1]
        cuts = np.r_[np.flatnonzero(np.r_[True, keeper[1:] != keeper[:-1]]), len(keys)]
        row, column = divmod(self.shard, self.grid)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            cell = row * self.grid + keeper[a] if kind == WORDS else keeper[a] * self.grid + column
            yield cell, kind, self.shard, keys[a:b], np.concatenate([v[a:b] for v in ints]).astype(np.int64), NONE

    def kept(self, tables):
        return self.shard, TABLES, self.shard, NONE, tables.astype(np.int64), NONE


def root(m: dict, customers, tables):
    """The root's probability of words with so many customers and tables."""
    return (customers - m["d0"] * tables + (lm.THETA + m["d0"] * m["S"]) * m["base"]) / (lm.THETA + m["R"])


def _tell(model: dict, grid: int, stage: int):
    """For one shard: seat, and write letters. Stage 0 opens, the last one averages."""

    def run(table, told):
        if not table.num_rows:
            return _letters([])
        s = Shard(table, told, model, grid, stage)
        if stage <= lm.ROUNDS:
            if stage:
                list(s.sweeps(lm.BURN_IN))
            words, rows = [s.of_words(s.tables)], [s.kept(s.tables)]
            if not stage:
                words.append(s.of_words(s.n))
                rows.append((s.shard, SUMS, s.shard, NONE, np.array([(s.n == 1).sum(), (s.n == 2).sum()]), NONE))
            return _letters([*rows, *s.letters(WORDS, words), *s.letters(PLACES, [s.of_contexts(s.tables)])])
        samples, places, total = [], [], np.zeros(len(s.n))
        for k, tables in enumerate(s.sweeps(lm.BURN_IN + lm.SAMPLES)):
            if k >= lm.BURN_IN:
                samples.append(s.of_words(tables))
                places.append(s.of_contexts(tables))
                total += tables
        return _letters([s.kept(total), *s.letters(WORDS, [*samples, s.of_words(s.n)]), *s.letters(PLACES, [s.of_contexts(s.n), *places])])

    return run


def _keep(model: dict, stage: int):
    """For one cell: add up what was told of its words and contexts, seat the root, answer."""

    def run(table):
        cell, rows = table.column("cell")[0].as_py(), []
        random = np.random.default_rng([lm.SEED, cell, stage, 1])
        own = _sorted(table, TABLES)
        rows += [(cell, TABLES, cell, NONE, lm.unpacked(own.column("ints"))[0], NONE)] if own.num_rows else []
        sums = np.zeros(SUMMED)
        singles = lm.unpacked(_sorted(table, SUMS).column("ints"))[0]
        if len(singles):
            sums[:2] = singles

        def added(kind):
            letters = _sorted(table, kind)
            keys, sizes = lm.unpacked(letters.column("keys"))
            known, inside = np.unique(keys, return_inverse=True)
            totals = [np.bincount(inside, weights=v, minlength=len(known)) for v in _columns(letters.column("ints"), sizes) if len(v)]
            return letters.column("source").to_numpy(), np.r_[0, np.cumsum(sizes)], inside, totals

        def answer(kind, sources, cuts, inside, ints, nums):
            for source, a, b in zip(sources.tolist(), cuts[:-1], cuts[1:], strict=True):
                i = inside[a:b]
                rows.append((source, kind, cell, NONE, np.concatenate([v[i] for v in ints]).astype(np.int64), np.concatenate([v[i] for v in nums]).astype(float) if nums else NONE))

        sources, cuts, inside, totals = added(WORDS)
        if len(sources):
            if stage <= lm.ROUNDS:
                customers = totals[0]
                # at the opening every word has one table
                seated = lm.reseat(customers, np.full(len(customers), (lm.THETA + model["d0"] * model["S"]) * model["base"]), model["d0"], random) if stage else np.minimum(customers, 1)
                sums[2:4] = customers.sum(), seated.sum()
                if not stage:
                    c = totals[1]
                    sums[4:8] = c.sum(), (c > 0).sum(), (c == 1).sum(), (c == 2).sum()
                answer(WORDS, sources, cuts, inside, [customers], [seated])
            else:
                mass = (lm.THETA + model["d0"] * model["S"]) * model["base"]
                seated = [lm.reseat(customers, np.full(len(customers), mass), model["d0"], random) for customers in totals[:-1]]
                sums[4 : 4 + lm.SAMPLES] = [root(model, c, t)[totals[-1] > 0].sum() for c, t in zip(totals[:-1], seated, strict=True)]
                # whole numbers, small for most words: the shards make the probabilities of them
                answer(WORDS, sources, cuts, inside, [totals[-1], *totals[:-1], *seated], [])
        sources, cuts, inside, totals = added(PLACES)
        if len(sources):
            # at the end: a context's customers and its tables in each sample
            answer(PLACES, sources, cuts, inside, totals, [np.zeros(len(totals[0]))] if stage <= lm.ROUNDS else [])
        return _letters([*rows, (-1, SUMS, cell, NONE, NONE, sums)])

    return run


@contextmanager
def tidy(spark):
    """Inside, the shuffle files of a finished job are deleted with it (its result is landed)."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_landed(table: DataFrame) -> None:
    """Delete a landed table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def train(shards: DataFrame, grid: int) -> tuple[dict, DataFrame]:
    """Totals and discounts of the whole model, and the last letters: to each shard the count of
    its words and their customers and tables in the root in each sample, the customers of its
    contexts and their tables in each sample, its tables."""
    # the questions of the chunks stay where they are
    pairs = shards.select("shard", "words", "contexts", "pair_word", "pair_context", "pair_n")
    letters = shards.sparkSession.createDataFrame([], LETTERS)
    discount = lambda one, two: float(np.clip(one / (one + 2 * two), 0.05, 0.95)) if one + two else 0.5
    model: dict = {}
    for stage in range(lm.ROUNDS + 2):
        told = pairs.groupBy("shard").cogroup(letters.groupBy("cell")).applyInArrow(_tell(dict(model), grid, stage), LETTERS)
        answers = land(told.groupBy("cell").applyInArrow(_keep(dict(model), stage), LETTERS), "letters")
        if stage:
            drop_landed(letters)
        letters = answers.where("cell >= 0")
        v = sum((lm.unpack(r["nums"]) for r in answers.where("cell < 0").select("nums").collect()), np.zeros(SUMMED))  # a few numbers for each cell
        if not stage:
            model = {"N": int(v[4]), "V": int(v[5]), "base": 1 / (v[5] + 1), "d1": discount(v[0], v[1]), "d0": discount(v[6], v[7])}
        if stage <= lm.ROUNDS:
            model |= {"R": v[2], "S": v[3]}
        else:
            model["wholes"] = [r + lm.unseen(model) for r in v[4 : 4 + lm.SAMPLES]]
            model["whole"] = sum(model["wholes"]) / lm.SAMPLES
    return model, letters


def answer(model: dict, grid: int):
    """For one shard: the log10 probability and the training count of each chunk's pairs."""

    def run(table, told):
        import pyarrow as pa

        s = Shard(table, told, model, grid, lm.ROUNDS + 2)
        p = np.ones(len(s.n))
        if model["N"]:
            asked_root = sum(e[s.context] * r[s.word] / whole for e, r, whole in zip(s.context_samples, s.word_samples, model["wholes"], strict=True))
            p = s.own(s.tables / lm.SAMPLES, s.context_ints[s.context]) + asked_root / lm.SAMPLES
        (steps, _), (n_pairs, _), (chunks, _) = (lm.unpacked(table.column(c)) for c in ("asked", "asked_n", "chunks"))
        asked = [np.cumsum(x) for x in np.split(steps, np.cumsum(n_pairs)[:-1])]
        figures = [_packed([v[i] for i in asked]) for v in (np.log10(p).astype(np.float32), s.word_ints[s.word])]
        return pa.table([pa.array(chunks, pa.int64()), pa.array(np.full(len(chunks), s.shard), pa.int32()), *figures], names=["chunk", "shard", "logp", "count"])

    return run
