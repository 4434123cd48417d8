"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a vector of transformed statistics (lengths, shares of kinds of characters,
repetition, line shape). Per class, a Gaussian is fitted to the labelled training rows: mean,
and a covariance shrunk towards the classes' pooled covariance and towards its diagonal, which
keeps it well conditioned with few rows. A score is the posterior of the good class: the
difference of two Mahalanobis log-densities, from Cholesky factors computed once on the driver
and sent along with the scoring tasks, through the logistic function.

Texts are read once: the statistics are landed, and both fitting and scoring use them. What
the driver receives for fitting is one row of sums per class and task, whatever the input.

Defined cases: null and empty texts have all-zero counts and are scored like any other;
very long texts are whole; without training rows of both classes every score is the share of
good ones among those there are (0.5 if none); a document labelled twice counts twice; null
ids have no label and are not held out; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.llm.common import bounded_batches, land, remainder, segment_sums, slices, texts_of, word_hashes

#: Share of the pooled covariance, then of the diagonal, in each class's covariance.
POOLED, DIAGONAL = 0.10, 0.10
#: Scores from here on predict the good class.
THRESHOLD = 0.3
HELD_MODULUS, HELD_REMAINDER = 5, 0
FEATURES = (
    "log_words", "word_length", "word_length_sd", "longest_word", "upper", "digits", "sentence_marks", "shouts", "symbols", "other_marks",
    "beyond_ascii", "log_lines", "line_words", "distinct_words", "top_word", "adjacent_repeats", "marked_words",
)


def features(texts: list[bytes]) -> np.ndarray:
    """A row of ``FEATURES`` for each text."""
    split = [t.split() for t in texts]
    n = np.array([len(w) for w in split], dtype=np.int64)
    ends = np.cumsum(n)
    starts = ends - n
    flat = [w for words in split for w in words]
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    codes = word_hashes(flat)
    doc = np.repeat(np.arange(len(texts)), n)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    byte_ends = np.cumsum([len(t) for t in texts])
    byte_starts = byte_ends - [len(t) for t in texts]
    kind = np.zeros(256, dtype=np.uint8)  # one kind for each byte
    for k, members in enumerate((range(65, 91), range(48, 58), b".,;:'\"()-", b"!?", b"#*$%&|<>@~^_=+/\\{}[]`", range(128, 256), b"\n"), 1):
        kind[list(members)] = k
    kinds = kind[data]
    share = {k: segment_sums((kinds == k).view(np.uint8), byte_starts, byte_ends) for k in range(1, 8)}
    size, words = np.maximum(byte_ends - byte_starts, 1), np.maximum(n, 1)
    mean = segment_sums(lengths, starts, ends) / words
    sd = np.sqrt(np.maximum(segment_sums(lengths**2, starts, ends) / words - mean**2, 0))
    longest = np.array([max(map(len, w), default=0) for w in split])
    order = np.lexsort((codes, doc))
    change = np.ones(len(codes), bool)
    if len(codes):
        d, c = doc[order], codes[order]
        change[1:] = (d[1:] != d[:-1]) | (c[1:] != c[:-1])
    at = np.flatnonzero(change)
    count = np.diff(np.r_[at, len(codes)])
    top = np.zeros(len(texts), dtype=np.int64)
    if len(codes):
        np.maximum.at(top, doc[order][at], count)
    distinct = np.bincount(doc[order][at], minlength=len(texts)) if len(codes) else np.zeros(len(texts), np.int64)
    again = np.zeros(len(codes), np.uint8)
    if len(codes):
        again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
    marked = np.zeros(len(flat), np.uint8)
    if len(flat):
        last = np.frombuffer(b"".join(w[-1:] for w in flat), np.uint8)
        marked = ((kind[last] >= 3) & (kind[last] <= 5)).view(np.uint8)
    lines = share[7] + 1
    root = lambda x: np.sqrt(np.maximum(x, 0))  # noqa: E731  tames the shares' skew
    return np.stack(
        [
            np.log1p(n), np.log1p(mean), np.log1p(sd), np.log1p(longest), root(share[1] / size), root(share[2] / size), root(share[3] / size), root(share[4] / size), root(share[5] / size),
            root(np.maximum(size - sum(share.values()), 0) / size), root(share[6] / size), np.log1p(lines), np.log1p(n / lines), distinct / words, root(top / words),
            root(segment_sums(again, starts, ends) / words), root(segment_sums(marked, starts, ends) / words),
        ],
        axis=1,
    ).astype(np.float64)


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x`` (the features) for each row of ``df``."""

    def compute(batches):
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                x = features(texts_of(part))
                column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), column], names=["doc_id", "x"])

    return bounded_batches(df).selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(compute, "doc_id bigint, x array<double>")


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def class_sums(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Rows, sum and sum of outer products of ``x`` for each ``y`` of ``labelled(y, x)``."""
    d = len(FEATURES)

    def sums(batches):
        import pyarrow as pa

        total = {}
        for batch in batches:
            x, y = matrix(batch.column("x")), batch.column("y").to_numpy()
            for k in np.unique(y):
                z = x[y == k]
                n, s, q = total.get(int(k), (0.0, 0.0, 0.0))
                total[int(k)] = (n + len(z), s + z.sum(0), q + z.T @ z)
        if total:
            rows = [np.r_[n, s, q.ravel()] for n, s, q in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([list(r) for r in rows], pa.list_(pa.float64()))], names=["y", "v"])

    parts = labelled.select(F.col("y").cast("int"), "x").mapInArrow(sums, "y int, v array<double>")
    added = parts.select("y", F.posexplode("v").alias("k", "v")).groupBy("y", "k").agg(F.sum("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for row in added.collect():  # 1 + d + d * d numbers a class
        out.setdefault(row["y"], np.zeros(1 + d + d * d))[row["k"]] = row["v"]
    return {y: (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d)) for y, v in out.items()}


def fit(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = POOLED, diagonal: float = DIAGONAL) -> dict:
    """Means, inverse Cholesky factors, log-determinants and the prior log-odds."""
    counts = {y: sums[y][0] if y in sums else 0.0 for y in (0, 1)}
    if min(counts.values()) < 2:
        total = sum(counts.values())
        return {"constant": counts[1] / total if total else 0.5}
    means = {y: sums[y][1] / counts[y] for y in (0, 1)}
    scatter = {y: sums[y][2] - counts[y] * np.outer(means[y], means[y]) for y in (0, 1)}
    common = (scatter[0] + scatter[1]) / (counts[0] + counts[1])
    model: dict = {"prior": float(np.log(counts[1] / counts[0]))}
    for y in (0, 1):
        cov = (1 - pooled) * scatter[y] / counts[y] + pooled * common
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        model[y] = (means[y], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum()))
    return model


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    density = {}
    for y in (0, 1):
        mean, inverse, log_det = model[y]
        z = (x - mean) @ inverse.T
        density[y] = -0.5 * (z * z).sum(1) - log_det
    return 1 / (1 + np.exp(-np.clip(model["prior"] + density[1] - density[0], -500, 500)))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    known = land(statistics(docs, id_col, text_col), "statistics")
    held = F.coalesce(remainder(F.col("doc_id"), HELD_MODULUS) == HELD_REMAINDER, F.lit(False))
    y = labels.select(F.col("doc_id").cast("bigint").alias("_id"), F.col(label_col).cast("int").alias("y")).where("_id is not null and y in (0, 1)")
    training = known.where(~held).join(y, F.col("doc_id") == F.col("_id"))
    model = fit(class_sums(training))

    def score(batches):
        import pyarrow as pa

        for batch in batches:
            s = scores(model, matrix(batch.column("x"))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    scored = known.mapInArrow(score, "doc_id bigint, score double")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
