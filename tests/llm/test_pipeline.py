"""The pipeline's stages, each judged on its own input."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from footmark.llm.common import Scope, cut, numbered
from footmark.llm.secret_scan import find_secrets

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORDS.findall(text.lower())
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "src0", None), (9002, "", None, None, 0), (9003, "12 !!", "en", "src1", 5)], docs.schema)
    tables, frame = [docs.union(extra).collect()], docs.union(extra)
    for _, stage in P.STAGES:
        frame = cut(stage(spark, frame, sf), "stage")
        tables.append(frame.collect())
    start, language, dedup, masked, mixed, packed = tables
    assert {r["doc_id"] for r in start} - {r["doc_id"] for r in language} == {9001, 9002, 9003}
    # one document of each group stays: every document that went is like one that stayed, directly or by others
    kept = {r["doc_id"] for r in dedup}
    assert kept <= {r["doc_id"] for r in language}
    sets = {r["doc_id"]: shingles(r["text"]) for r in language}
    alike = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])
    for a in kept:
        assert not any(alike(a, b) for b in kept if b < a and min(len(sets[a]), len(sets[b])) * 10 >= max(len(sets[a]), len(sets[b])) * 8)
    assert all(any(alike(a, b) for b in sets if b < a) for a in sets.keys() - kept)
    before = {r["doc_id"]: r["text"] for r in dedup}
    assert {r["doc_id"] for r in masked} == kept
    for r in masked:
        assert (r["text"] == before[r["doc_id"]]) == (not find_secrets(before[r["doc_id"]])) and r["n_chars"] == len(r["text"])
        assert not find_secrets(r["text"])
    clean = {r["doc_id"]: WORDS.findall(r["text"]) for r in masked}
    for r in mixed:
        assert set(WORDS.findall(r["text"])) <= set(clean[r["doc_id"]])
    assert 0.9 < sum(len(WORDS.findall(r["text"])) for r in mixed) / sum(map(len, clean.values())) < 1.1
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}
    assert [list(t[0].asDict()) for t in tables[:5]] == [docs.columns] * 5
    assert P.run(spark, sf).count() > 0


def test_near_duplicates_by_row(spark):
    """Ids with several texts, repeated rows and rows without an id: one row of each group stays, and nothing else goes."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    like_a = a.replace("a59", "other")
    rows = [(1, a), (5, like_a), (5, b), (5, c), (5, c), (7, b), (3, c), (None, d), (None, d), (None, a), (8, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = P.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    want = [(1, a), (5, b), (3, c), (None, d), (8, ""), (8, None)]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in got.collect()))) == sorted(map(str, want))


def test_stages_on_awkward_tables(spark):
    """Nulls, empty and long texts, repeated rows, ids of several rows, columns of any name, empty tables; plain scans and plans."""
    rng = random.Random(4)
    vocab = {"en": "the and of that with this is for house water garden small".split(), "fr": "le la les des une avec pour maison eau jardin".split()}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang]) + rng.choice(["", "", "s", "er"]) for _ in range(n))
    rows = [(i, text("en" if i % 3 else "fr", rng.randint(40, 90)), "en" if i % 3 else "fr", f"s{i % 3}") for i in range(60)]
    rows += [(60, None, "en", None), (61, "", None, "s1"), (62, " \t", "en", "s1"), (63, text("en", 30000), "en", "s0"), (None, text("fr", 50), None, "s2"),
             (64, "漢字仮名交 " * 30, None, "s1"), (65, "password = hunter2secret " + text("en", 40), "en", "s2")]
    rows += [rows[3]] * 3 + [(5, rows[7][1], "en", "s0"), (5, text("en", 60), "en", "s0")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, row int, seen int, blob string, spans int, c1 int, mix_uid int, `x``y` int"
    frame = spark.createDataFrame([(*r, len(r[1] or ""), "dot", n, 2, "b", 3, 4, 5, 6) for n, r in enumerate(rows)], schema)
    for docs in (cut(frame, "plain"), frame.repartition(3)):
        for name, stage in P.STAGES[:-1]:
            out = cut(stage(spark, docs, ""), "stage")
            assert out.columns == frame.columns and [f.dataType for f in out.schema] == [f.dataType for f in frame.schema], name
            extra = {(r["row"], r["a.b"], r["seen"], r["blob"], r["spans"], r["c1"], r["mix_uid"], r["x`y"]) for r in out.collect()}
            assert extra <= {(n, "dot", 2, "b", 3, 4, 5, 6) for n in range(len(rows))}, name
            gone = {r[0] for r in rows} - {r["doc_id"] for r in out.collect()}
            if name == "language ID":
                assert gone == {60, 61, 62, 64}      # no letter, or none that a learned language has
                assert out.count() == len(rows) - 4
            if name == "secret scan":
                assert "hunter2" not in "".join(r["text"] or "" for r in out.collect())
            docs = out
        assert P.STAGES[-1][1](spark, docs, "").count() > 0
    empty = frame.limit(0)
    for docs in (empty, cut(empty, "empty")):
        for name, stage in P.STAGES:
            assert stage(spark, docs, "").count() == 0, name


def test_scopes_remove_tables(spark, tmp_path):
    """A stage's own tables go when the next stage is called, and those that its input reads stay."""
    scope = Scope()
    with scope:
        one, two = cut(spark.range(5).toDF("a"), "one"), cut(spark.range(6).toDF("a"), "two")
    scope.clear(keep=one)
    assert one.count() == 5 and len(scope.paths) == 1
    with pytest.raises(Exception):
        two.count()
    scope.clear()
    assert not scope.paths


def test_row_numbers_by_file(spark):
    """Numbers of a table's rows don't depend on how its files are split."""
    docs = cut(spark.range(1000).select(F.col("id"), F.repeat(F.lit("x"), 200).alias("row")).repartition(3), "numbers")
    rows, key = numbered(docs)
    assert key == "_row" and rows.columns == ["id", "row", "_row"]
    first = {r["id"]: r[key] for r in rows.collect()}
    assert len(set(first.values())) == 1000
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    assert {r["id"]: r[key] for r in numbered(docs)[0].collect()} == first
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
