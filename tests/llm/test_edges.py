"""Nulls, empty tables, repeated rows and clashing columns in every operator, and the pipeline."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attestry.llm import bpe, classifier, fingerprint, minhash, packing, pii, quality, queries, secrets, substring, urls
from attestry.llm import words as W

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.001"


def _bpe(d):
    return bpe.encoded(d, pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))


OPERATORS = {
    "urls": lambda s, d: urls.judged(d.withColumnRenamed("text", "url"), s.createDataFrame(queries.URL_RULES, "host string, path string, verdict string"), id_col="doc_id"),
    "packing": lambda s, d: packing.packed(packing.word_lengths(d)),
    "bpe": lambda s, d: _bpe(d),
    "minhash": lambda s, d: minhash.near_duplicates(d),
    "substring": lambda s, d: substring.remove_repeats(d),
    "quality": lambda s, d: quality.judged(d),
    "fingerprint": lambda s, d: fingerprint.fingerprints(d),
    "classifier": lambda s, d: classifier.scored(d, s.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, None)], LABELS)),
    "pii": lambda s, d: pii.found(d),
    "secrets": lambda s, d: secrets.found(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows(spark, name):
    rows = [(None, "a b c", None, None, None), (1, None, None, None, None), (1, None, None, None, None), (2, "", "", "", 0), (3, "x y z " * 40, "en", "s", 1), (3, "x y z " * 40, "en", "s", 1), (-5, "x y z " * 40, "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "key", "node", "n", "rest", "tag", "score", "kept", "spans", "n_words", "host"):
        df = df.withColumn(c, F.lit("mine"))
    got = OPERATORS[name](spark, df).collect()
    assert len(got) == len(rows)
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("length", [4, 13, 50])
def test_blocks_of_every_word_count(length):
    for n in range(2 * length + 1):
        words = W.split(*W.text_bytes(pa.array([" ".join(f"w{k}" for k in range(n))])))
        assert (len(substring._anchors(words, length)[0]) > 0) == (n >= length)
        for width in (1, 2, 3, length - 1, length):
            want = [min(range(i, i + width)) for i in range(n - width + 1)]
            assert substring._sliding(np.arange(n, dtype=np.uint64), width, np.minimum).tolist() == want


def test_one_short_row_has_no_passage(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(35)), "en", "s", 1)]
    got = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.n_words, r.n_removed, r.kept_text) for r in got] == [(35, 0, rows[0][1])]


def test_pipeline_stages(spark, tmp_path):
    body = [" ".join(f"w{(i * 37 + k * k) % 5003}" for k in range(120)) for i in range(12)]
    shared = " ".join(f"p{k}" for k in range(60))
    rows = [(i, f"{t}\nmail me@x{i}.com", "en", "s", len(t)) for i, t in enumerate(body)]
    rows += [(20, rows[3][1], "en", "s", 1), (21, rows[4][1] + " extra", "en", "s", 1), (22, "too short", "en", "s", 9), (23, None, None, None, None)]
    rows += [(30 + i, body[i] [: 300] + f" q{i} {shared} " + " ".join(f"t{i}x{k}" for k in range(60)), "fr", "s", 5) for i in (5, 6)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs
    ids = lambda d: sorted(r.doc_id for r in d.collect())
    clean = [*range(12), 20, 21, 35, 36]
    assert ids(seen["quality_rules"]) == clean
    assert ids(seen["near_dedup"]) == [i for i in clean if i not in (20, 21)]
    after = {r.doc_id: r.text for r in seen["substring_dedup"].collect()}
    assert "p30" in after[35] and "p30" not in after[36] and after[0] == rows[0][1]
    for name in ("quality_rules", "near_dedup", "substring_dedup", "pii"):
        assert seen[name].columns == ["doc_id", "text", "lang", "source", "n_chars"] and dict(seen[name].dtypes)["n_chars"] == "bigint"
    assert all("<email>" in r.text and not re.search("@", r.text) for r in seen["pii"].where("doc_id < 12").collect())
    assert sorted({r.doc_id for r in docs.collect()}) == ids(seen["pii"])
    assert docs.groupBy("bin_id").agg(F.sum("piece_tokens").alias("t"), F.first("bin_size").alias("s")).where("t > s").count() == 0


def test_registered_queries(spark):
    found = queries.queries()
    assert {re.match(r"op(\d+)_", n)[1] for n in found if n.startswith("op")} == {str(k) for k in range(1, 14)} and "pipeline" in found
    for name in ("op1_packing", "op2_urls", "op9_pii", "op10_secrets"):
        df = found[name](spark, SF)
        assert df.count() > 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_tables(spark, name, stage):
    last = name == corpus_pipeline.STAGES[-1][0]
    columns = "doc_id long, text string, _features string, id string, rest map<string, int>"
    assert stage(spark, spark.createDataFrame([], columns), "").collect() == []
    body = " ".join(f"w{k * k % 977}" for k in range(90))
    rows = [(1, body, "a", "b", {"k": 1}), (1, body, "a", "b", {"k": 1}), (None, body, None, None, None), (3, body + " more here.", "a", None, None), (4, None, "a", "b", None)]
    got = stage(spark, spark.createDataFrame(rows, columns), "")
    if last:
        assert got.where("bin_offset + piece_tokens > bin_used").count() == 0 and got.count() == len(rows)
        return
    assert got.columns == ["doc_id", "text", "_features", "id", "rest"]
    ids = sorted(str(r.doc_id) for r in got.collect())
    assert ids == {
        "quality_rules": ["1", "1", "3", "None"],
        "near_dedup": ["1", "4", "None"],
        "substring_dedup": ["1", "1", "3", "4", "None"],
        "pii": ["1", "1", "3", "4", "None"],
    }[name]


def test_one_outlying_id_leaves_ranges_even(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "PART_CHARS", 2000)
    base = [(i, f"text {i} " * 5) for i in range(2000)]
    for rows in (base, [*base, (2**62, "x"), (-(2**62), "y")], [(None, t) for _, t in base], [(7 if i % 3 == 0 else i, t) for i, t in base]):
        for knots in (8192, 16):
            monkeypatch.setattr(fingerprint, "KNOTS", knots)
            dealt, *_ = fingerprint._in_order(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
            spans = dealt.groupBy("span").agg(F.count("*").alias("n"), F.min(F.struct("at", "tie")).alias("lo"), F.max(F.struct("at", "tie")).alias("hi")).orderBy("span").collect()
            assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(spans, spans[1:], strict=False))
            assert max(r.n for r in spans) <= (40 if knots > 16 else 300)


def test_long_host_and_url(spark):
    long = "http://" + ".".join(["a"] * 10_000) + ".example.com/en/7" + "x" * 100_000
    got = urls.judged(spark.createDataFrame([(1, long)], "page_id long, url string"), spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")).first()
    assert (got.rule, got.verdict) == ("example.com/en/7", "allow")


@pytest.mark.parametrize("few", [minhash.FEW_NODES, 0])
def test_components_of_chains_stars_and_nothing(spark, few, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_NODES", few)
    chain, star = [(k, k + 1) for k in range(30)], [(100, k) for k in range(101, 160)]
    found = minhash.components(spark.createDataFrame([*chain, *star, (500, 499), (500, 501)], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 160)} | {k: 499 for k in (499, 500, 501)}
    assert minhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_graphs_take_few_tasks_however_many_partitions(spark):
    keys = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, context = {k: spark.conf.get(k) for k in keys}, spark.sparkContext
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        context.setJobGroup("graph", "")
        assert {r.root for r in minhash.components(edges).collect()} == {0}
        context.setJobGroup("other", "")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    told = context.statusTracker()
    jobs = [told.getJobInfo(j) for j in told.getJobIdsForGroup("graph")]
    stages = [told.getStageInfo(i) for i in {i for j in jobs if j for i in j.stageIds}]
    assert sum(s.numCompletedTasks for s in stages if s) < 5 * 61 + 200
