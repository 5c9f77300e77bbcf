"""op11 to op13 against brute force, with nulls, empty and long values, ties, repeated rows, empty tables
and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from footmark.llm import centroid_drift, importance_radix, url_cascade
from footmark.llm.centroid_drift import loosening
from footmark.llm.common import cut

# --- url rules -------------------------------------------------------------------------------------

PAGES = "page_id long, url string, host string, found string, `best` int, `a.b` int, lengths int"
URLS = ["http://www.example.com/en/1", "https://EXAMPLE.com/en/", "http://m.example.com/en/x?y=/en/", "http://example.com/e", "http://a.net/es/",
        "http://net/fr/1", "http://planet/fr/1", "http://x.net/frx/", "ftp://x.net", "http://com", "http://com/", "http://x.com#/en/", "http://x.com?a/",
        "", None, "example.com/en/", "://", ":///en/", "http://www.example.com/EN/", "http://x.example.com./en/", "http://É.NET/es/ü",
        "http://a..com/", "http://.com/x", "http://" + "a." * 30000 + "net/es/" + "y" * 50000, "http://b.org/a\nb/en/", "x://y://z.com/",
        "http://x.net:80/es/", "http://user@x.net/es/"]
MANY = [("block", f"d{i}.org", p) for i in range(60) for p in ("", "/", "/a/", "/a/b")] + [("allow", f"x.d{i}.org", "/a") for i in range(0, 60, 3)]


def judged(url, rules):
    rest = url[url.index("://") + 3:] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), len(h), h + p, a == "block") for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], "block" if best and best[3] else "allow"


@pytest.mark.parametrize("rules,max_bits", [(url_cascade.RULES, 1 << 25), (MANY, 1 << 25), (MANY, 300)])
def test_url_cascade(spark, rules, max_bits):
    rng = random.Random(3)
    urls = URLS + [f"http://{rng.choice(['', 'x.', 'q.x.', 'y.'])}d{rng.randrange(70)}.org{rng.choice(['', '/', '/a', '/a/', '/a/b', '/b/a/b'])}" for _ in range(500)]
    urls += urls[:40]
    rows = [(i if i % 9 else None, u, "clash", "clash", 7, 8, 9) for i, u in enumerate(urls)]
    pages = cut(spark.createDataFrame(rows, PAGES).repartition(4), "pages")
    got = url_cascade.judge(pages, url_cascade.rule_table(spark, rules), max_bits=max_bits)
    assert got.columns == ["page_id", "url", "found", "best", "a.b", "lengths", "host", "path", "rule", "verdict"]
    want = sorted(repr((r[0], *judged(r[1], rules), 7, 8)) for r in rows)
    assert sorted(repr((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], r["best"], r["a.b"])) for r in got.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Join|Exchange|Python|Arrow", plan)


def test_url_cascade_edges(spark):
    pages = spark.createDataFrame([(1, "http://x.com/a"), (2, "http://y.com/a")], "page_id long, url string")
    rules = spark.createDataFrame([("allow", "x.com", "/"), ("block", "X.com", "/"), ("other", "y.com", "/"), (None, "y.com", "/"), ("block", None, "/"),
                                   ("block", "", "/"), ("block", "y.comx", None), ("block", "y.com", "a"), ("block", "y.c", "om/a")],
                                  "action string, host string, path string")
    assert [tuple(r) for r in url_cascade.judge(pages, rules).orderBy("page_id").select("rule", "verdict").collect()] == \
        [("x.com/", "block"), (None, "allow")]
    assert [r["verdict"] for r in url_cascade.judge(pages, rules.limit(0)).collect()] == ["allow"] * 2
    assert url_cascade.judge(pages.limit(0), rules).collect() == []
    every = spark.createDataFrame([("block", "x.com", "/"), ("block", "com", "/"), ("block", "y.com", "/")], "action string, host string, path string")
    assert [r["verdict"] for r in url_cascade.judge(pages, every).collect()] == ["block"] * 2  # no unlisted key


@pytest.mark.parametrize("n_in,n_out", [(40, 4000), (1500, 1500), (3000, 10), (1, 1)])
def test_cascade_is_exact(spark, n_in, n_out):
    keys = cut(spark.range(n_in + n_out).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") < n_in).alias("listed")), "keys")
    cascade = url_cascade.build(keys)
    assert keys.filter(cascade.contains(F.col("key")) != F.col("listed")).count() == 0
    if n_in == n_out == 1500:
        assert len(cascade.levels) > 3


# --- importance resampling -------------------------------------------------------------------------

DOCS = "doc_id long, text string, uid string, score string, weight int, block int"


def sampled(docs, target, run=1, buckets=10000, least=20, percent=10):
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, run + 1) for i in range(len(w) - k + 1)]
    here, there = np.zeros(buckets), np.zeros(buckets)
    for t in target:
        np.add.at(there, feats(t)[1], 1)
    for _, t in docs:
        np.add.at(here, feats(t)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (here.sum() + buckets) / ((a + 1) * (there.sum() + buckets)))) for a, b in zip(here, there)]
    out = []
    for i, t in docs:
        n, f = feats(t)
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(repr(tuple(r[:5])) for r in out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)] + ["É", "漢字", "a_b", "X9", "it's", "\x00", "🙂z"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    docs = [(i * 7 - 900, text(rng.choice([0, 5, 19, 20, 21, 60]))) for i in range(400)]
    docs += [(None, text(30)), (None, text(30)), (-(1 << 63), text(40)), ((1 << 63) - 1, text(40)), (5000, None), (5001, ""), (5002, text(60000))]
    docs += [docs[3]] * 50 + [(77, "same words " * 15)] * 30
    return docs, [text(50) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("how", [{}, {"run": 2, "buckets": 70000, "percent": 100, "least": 1}])
def test_importance(spark, corpus, how, monkeypatch):
    monkeypatch.setattr(importance_radix, "BLOCK", 64)          # several blocks
    docs, target = corpus
    frame = spark.createDataFrame([(*d, "clash", "clash", 7, 9) for d in docs], DOCS).repartition(5)
    got = importance_radix.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert sorted(repr(tuple(r)) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == sampled(docs, target, **how)


def test_importance_edges(spark, corpus):
    docs, target = corpus
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    rows = lambda d: spark.createDataFrame(d, "doc_id long, text string")
    pick = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    assert importance_radix.resample(rows([]), goal).collect() == []
    assert pick(importance_radix.resample(rows(docs[:60]), goal.limit(0))) == sampled(docs[:60], [])
    same = [(None, "a " * 30)] * 25                                # one key for all rows
    assert pick(importance_radix.resample(rows(same), goal)) == sampled(same, target)


def test_features_by_pieces():
    text = "aa b ccc d " * 50
    for run in (1, 2, 3):
        whole = sorted(f for _, some in importance_radix.features(text, run) for f in some)
        assert whole == sorted(f for _, some in importance_radix.features(text, run, piece=7) for f in some)


# --- centroid clustering ---------------------------------------------------------------------------

VECS = "vec_id long, embedding array<double>, cluster string, upper int, v int"


def clustered(rows, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents))
    for turn in range(rounds + 1):
        got = [near(v) for _, v in kept]
        if turn < rounds:
            members = {}
            for (_, v), (_, j) in zip(kept, got):
                members.setdefault(j, []).append(v)
            for j, vs in members.items():
                cents[j] = [sum(x) // len(vs) for x in zip(*vs)]
    inertia = [sum(d for d, c in got if c == j) for j in range(len(cents))]
    return sorted(repr((i, j, d, inertia[j], sum(inertia), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()))
                  for (i, _), (d, j) in zip(kept, got))


def vectors(spark, rows, parts=4):
    return spark.createDataFrame([(i, e, "clash", 1, 2) for i, e in rows], VECS).repartition(parts)


def digest(df):
    return sorted(repr(tuple(r)) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


def test_clusters(spark):
    rng = np.random.default_rng(2)
    mid = rng.normal(size=(12, 64))
    rows = [(i, (mid[i % 12] + 0.3 * rng.normal(size=64)).tolist()) for i in range(400)]
    rows += [(1000, None), (1001, []), (1002, [0.0] * 63), (1003, [0.0] * 63 + [float("nan")]), (1004, [0.0] * 63 + [None]), (1005, [float("inf")] * 64),
             (None, [0.1] * 64), (None, [0.1] * 64), (1006, [0.0] * 64), (1006, [0.0] * 64), (3, rows[3][1]), (1007, [-1.0] * 64), (1008, [0.0] * 65)]
    rows += [(2000 + i, [0.5] * 64) for i in range(200)]          # copies
    assert digest(centroid_drift.centroid_clusters(vectors(spark, rows))) == clustered(rows)
    large = rows[:100] + [(3000 + i, [1e6 * (i % 3) + i] * 64) for i in range(20)] + [(4000 + i, [3e7 + i] + [0.0] * 63) for i in range(9)]
    assert digest(centroid_drift.centroid_clusters(vectors(spark, large))) == clustered(large)


def test_clusters_edges(spark):
    few = [(i, [float(i % 2)] * 64) for i in range(5)]             # fewer vectors than clusters, equal centroids, empty clusters
    assert digest(centroid_drift.centroid_clusters(vectors(spark, few))) == clustered(few)
    assert centroid_drift.centroid_clusters(vectors(spark, [])).collect() == []
    assert centroid_drift.centroid_clusters(vectors(spark, [(1, None)])).collect() == []
    with pytest.raises(Exception, match="don't fit a long"):
        centroid_drift.centroid_clusters(vectors(spark, [(1, [1e300] * 64)])).collect()


def test_bounds_spare_scans(spark):
    """Well separated clusters: the tight bound leaves fewer vectors to scan than the full drift."""
    rng = np.random.default_rng(4)
    mid = 2 * rng.normal(size=(10, 8))
    rows = [(i, (mid[i % 10] + rng.normal(size=8)).tolist()) for i in range(3000)]
    left = {}
    for tight in (True, False):
        state, _ = centroid_drift.cluster(vectors(spark, rows), dims=8, rounds=3, tight=tight)
        left[tight] = state.filter("scanned").count()
        assert state.count() == 3000
    assert left[True] < left[False] < 3000


def test_loosening_is_a_bound():
    rng = np.random.default_rng(6)
    tighter = 0
    for _ in range(300):
        d = int(rng.integers(1, 6))
        c, p, q = rng.normal(size=(3, d)) * rng.choice([0.1, 1, 5])
        r = abs(rng.normal())
        bound, drift = loosening(c, r, p, q), np.linalg.norm(q - p)
        x = rng.normal(size=(2000, d))
        x = c + r * x / np.linalg.norm(x, axis=1)[:, None] * rng.choice([1, 1, 0.5], size=(2000, 1))
        assert (np.linalg.norm(x - p, axis=1) - np.linalg.norm(x - q, axis=1)).max() <= bound + 1e-9
        assert bound <= drift * (1 + 1e-9)
        tighter += bound < 0.9 * drift
    assert tighter > 100
    assert loosening([0.0], 1.0, [5.0], [5.0]) == 0.0
