from __future__ import annotations

import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from edge_cases import edge, edge_rows, nothing  # noqa: F401  (fixtures)
from feedlens.llm import lm_score, mixing, quality_classifier, quality_rules, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_rules(text):
    w = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    shares, chars = [], max(1, sum(map(len, w)))
    inside5 = set()
    for n in sorted(quality_rules.NGRAM_LIMITS):
        grams, again = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)), set()
        first = set()
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            if n == 5 and grams[g] > 1:
                inside5.update(range(i, i + n))
            if g in first:
                again.update(range(i, i + n))
            first.add(g)
        shares.append(sum(len(w[i]) for i in again) / chars)
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(inside5)], shares


def test_quality_rules_edge_cases(edge, edge_rows, nothing):
    got = sorted(quality_rules.quality_rules(edge).collect(), key=str)
    assert len(got) == len(edge_rows)
    want = {(r[0], r[1]): brute_rules(r[1] or "") for r in edge_rows}
    by_id = defaultdict(list)
    for (i, _), v in want.items():
        by_id[i].append(v)
    for r in got:
        figures = [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words]
        match = [s for f, s in by_id[r.doc_id] if f == figures]
        assert match and any(np.allclose(r.dup_ngram_shares, s) for s in match)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.kept and r.base_failed)
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in got)
    assert quality_rules.quality_rules(nothing).count() == 0 and quality_rules.keep_good(nothing).count() == 0


def test_repetition_figures_against_brute_force():
    rng = random.Random(5)
    texts = []
    for _ in range(120):
        w = [rng.choice("abcdé") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        texts.append("".join(x + rng.choice([" ", " ", "\n", "  ", "\t#"]) for x in w))
    m = quality_rules.measure([t.encode() for t in texts])
    for k, t in enumerate(texts):
        figures, shares = brute_rules(t)
        assert [int(m[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] == figures
        assert np.allclose(m["shares"][k], shares)


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 300)), rng.choice(["a", "b", "c", "d", None]) if i % 3 else "a") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again)) and len(got) == len(rows)
    source = {r[0]: r[2] for r in rows}
    size = defaultdict(int)
    for i, t, s in rows:
        size[s] += len(t.split())
    names = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, target, free = sum(size.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * size[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * size[s] for s in over}
        free -= over
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and math.isclose(r.target, target[s], rel_tol=1e-9) and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= max(30, 0.002 * target[s])


def test_mix_is_unequal_by_size(spark):
    df = spark.createDataFrame([(i, " ".join(["w"] * (3 if i % 2 else 80)), "ab"[i % 20 == 0]) for i in range(4000)], "doc_id bigint, text string, source string")
    got = mixing.mix(df).groupBy("size").avg("n_copies").collect()
    assert {r[0]: r[1] for r in got}[3] < {r[0]: r[1] for r in got}[80]


def test_mix_edge_cases(edge, edge_rows, nothing):
    got = mixing.mix(edge).collect()
    assert len(got) == len(edge_rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    rows = mixing.mixed(edge)
    assert rows.columns == edge.columns and rows.count() == sum(r.n_copies for r in got)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


URLS = [
    "http://a.example.com/en/1", "HTTP://WWW.Example.COM/en/x?y", "https://www.example.com/fr/", "http://b.net/es/1", "http://b.net/fr", "http://b.net/fr/", "http://net/fr/x",
    "http://com", "http://x.org/casino/", "http://x.org/mycasino/", "http://free-bets.x.org/a", "http://x.org/docs/login", "http://x.org/login", "http://x.org/a?sessionid=3",
    "http://ads.research.x.org/ads/1/banner", "http://x.org/ads/1/2/banner", "x.org/casino/", "", "://", "http://x.org/tag/a/page/2", "http://x.org/f.exe", "http://x.org/f.exec", "http://x.org/XXX-y", "http://notcom.comx/",
]


HAND_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def pattern_fits(pattern: str, url: str) -> bool:
    """The pattern language read character by character, without regular expressions."""

    def here(p: str, s: str) -> bool:
        for k, c in enumerate(p):
            if c == "*":
                return any(here(p[k + 1 :], s[j:]) for j in range(len(s) + 1))
            if c == "^":
                if not s:
                    return here(p[k + 1 :], s)
                if s[0].isascii() and (s[0].isalnum() and not s[0].isupper() or s[0] in "_.%-"):
                    return False
            elif not s.startswith(c):
                return False
            s = s[1:]
        return True

    body = pattern.removeprefix("@@")
    if not body.startswith("||"):
        return any(here(body, url[k:]) for k in range(len(url) + 1) if body[0] in "*^" or url.startswith(body[0], k))
    scheme, found, rest = url.partition("://")
    if not found or not scheme[:1].isascii() or not scheme[:1].isalpha() or not all(c.isascii() and (c.isalnum() or c in "+.-") for c in scheme):
        return False
    host = rest[: min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))]
    return any(here(body[2:], rest[k:]) for k in [0, *(j + 1 for j, c in enumerate(host) if c == ".")])


def brute_url(url):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    best = max((r for r in HAND_RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])), key=lambda r: len(r[1] + r[2]), default=None)
    fits = lambda p: url is not None and pattern_fits(p, fold)
    if best:
        return host, path, best[1] + best[2], best[0], None
    if any(fits(p) for p in url_filter.PATTERNS if p.startswith("@@")):
        return host, path, None, "allow", None
    hit = next((p for p in url_filter.PATTERNS if not p.startswith("@@") and fits(p)), None)
    return host, path, None, "block" if hit else "allow", hit


def test_url_filter_edge_cases(spark):
    rows = [(i if i % 5 else None, u, "v") for i, u in enumerate([*URLS, None, *URLS[:3], "http://x.org/" + "a/" * 20_000])]
    got = url_filter.url_filter(spark.createDataFrame(rows, "page_id bigint, url string, verdict string")).collect()
    want = Counter((i, *brute_url(u)) for i, u, _ in rows)
    assert Counter(map(tuple, got)) == want
    assert {"-casino." not in str(r) for r in got} and url_filter.url_filter(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


def test_pages_against_the_hand_typed_oracle(spark):
    import duckdb

    path = "/root/testdata/sf0.01/pages.parquet"
    duckdb.sql(f"create or replace view pages as select * from '{path}'")
    got = url_filter.url_filter(spark.read.parquet(path))
    want = duckdb.sql(url_filter.oracle_sql())
    assert Counter(tuple(r[c] for c in want.columns) for r in got.collect()) == Counter(want.fetchall())
    assert [p for p, _ in url_filter._ORACLE_PATTERNS] == [p for p in url_filter.PATTERNS if not p.startswith("@@")]


def test_every_fitting_url_has_the_indexed_token():
    """Any url a pattern fits has each of the pattern's tokens whole."""
    for url in URLS + ["http://h.casino.org/poker/x", "http://a.b/ads/x/y/banner?z", "http://q/?a=1&phpsessid=2", "http://q/wp-login.php"]:
        tokens = set(re.split("[^a-z0-9]+", url.lower()))
        for p in url_filter.PATTERNS:
            if re.search(url_filter.regex_of(p), url.lower()):
                assert set(url_filter.tokens_of(p)) <= tokens, (p, url)


def test_index_uses_the_rarest_token():
    buckets, untokened = url_filter.index_of(("/ads/*/banner^", "xx"), {"ads": 50, "banner": 2})
    assert [e["token"] for b in buckets for e in b] == ["banner"] and untokened == ["xx"]
    json.dumps(buckets)


def test_classifier_on_shared_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_classifier_edge_cases(spark, edge, edge_rows, nothing):
    labels = spark.createDataFrame([(r[0], None if k == 3 else k % 2) for k, r in enumerate(edge_rows)], "doc_id bigint, quality int")
    for l in (labels, labels.where("quality = 1"), labels.limit(0)):
        got = quality_classifier.quality_scores(edge, l).collect()
        assert len(got) == len(edge_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.quality_scores(nothing, labels).count() == 0


def test_classifier_matches_dense_formula():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(400, len(quality_classifier.FEATURES))), rng.integers(0, 2, 400)
    x[y == 1] += 0.5
    sums = {k: (float((y == k).sum()), x[y == k].sum(0), x[y == k].T @ x[y == k]) for k in (0, 1)}
    got = quality_classifier.scores(quality_classifier.fit(sums), x)
    logs = []
    common = sum(np.cov(x[y == k].T, bias=True) * (y == k).mean() for k in (0, 1))
    for k in (0, 1):
        cov = 0.9 * np.cov(x[y == k].T, bias=True) + 0.1 * common
        cov = 0.9 * cov + 0.1 * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
        z = x - x[y == k].mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1] + np.log((y == k).mean()))
    assert np.allclose(got, 1 / (1 + np.exp(logs[0] - logs[1])))


def test_lm_scores_edge_cases(edge, edge_rows, nothing):
    got = lm_score.lm_scores(edge).collect()
    tokens = lambda t: [*WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")), None]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for r in edge_rows if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = sorted((str(r[0]), held(r[0]), len(tokens(r[1])), sum(c[w] > 0 for w in tokens(r[1])), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(r[1])), 4)) for r in edge_rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 and r.perplexity >= 1 for r in got)
    assert lm_score.lm_scores(nothing).count() == 0


def test_lm_without_training_rows(spark):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = lm_score.lm_scores(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)


def test_lm_beats_its_base_on_held_out_documents(spark):
    got = lm_score.lm_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_reseat_follows_the_seating_process():
    """Mean tables of one customer after another, against the block sampler."""
    rng = np.random.default_rng(1)
    n, mass, d = 40, 0.7, 0.4
    exact = []
    for _ in range(3000):
        t = 1
        for i in range(1, n):
            t += rng.random() < mass / (mass + i - d * t)
        exact.append(t)
    got = lm_score.reseat(np.full(3000, n), np.full(3000, mass), d, rng)
    assert abs(got.mean() - np.mean(exact)) < 0.15


@pytest.mark.parametrize("n", [0, 1, 2, 10**7])
def test_reseat_bounds(n):
    (t,) = lm_score.reseat(np.array([n]), np.array([2.0]), 0.5, np.random.default_rng(0))
    assert min(n, 1) <= t <= max(n, 0)
