"""The pipeline's stages against the operators' brute-force rules, and the operators' queries."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from stratalog.llm import queries

from test_decontam import brute as contaminated_by
from test_pii import plain as seed_spans
from test_secret_scan import base_spans
from test_simhash import groups, plain_code

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def test_all_registered():
    assert {*queries.QUERIES} <= {*spark_entry.queries()}
    assert sum(n.startswith("op") and n[2].isdigit() for n in queries.QUERIES) == 13 and "pipeline" in queries.QUERIES


def test_scans_equal_brute_force(spark, docs):
    texts = {d["doc_id"]: d["text"] or "" for d in docs}
    secrets = {r["doc_id"]: r for r in queries.op7_secret_scan(spark, SF).collect()}
    personal = {r["doc_id"]: r for r in queries.op9_pii(spark, SF).collect()}
    assert secrets.keys() == personal.keys() == texts.keys()
    for i, t in texts.items():
        want = base_spans(t)
        assert secrets[i]["base_sha256"] == digest(want) and secrets[i]["n_hex"] == sum(k == "hex" for k, _, _ in want)
        want = seed_spans(t)
        assert personal[i]["base_sha256"] == digest(want) and personal[i]["n_card"] == sum(k == "card" for k, _, _ in want)


def test_stages(spark, docs):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    columns = frame.columns
    want = [d for d in docs if d["text"] and any(map(str.isalpha, d["text"]))]
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
        if name == "near_duplicates":
            codes = [plain_code(d["text"]) for d in want]
            least = defaultdict(list)
            for d, root in zip(want, groups(codes), strict=True):
                least[root].append(d)
            want = [min(g, key=lambda d: d["doc_id"]) for g in least.values()]
        if name == "decontamination":
            want = [d for d in want if not contaminated_by(d["text"], bench)[3]]
        assert Counter(r["doc_id"] for r in frame.collect()) == Counter(d["doc_id"] for d in want)
    mixed = corpus_pipeline.mix_sources(spark, frame, SF)
    assert mixed.columns == columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3


def test_hard_rows_pass_all_stages(spark):
    data = [(1, "plain words of a text", "en", "a", 1, "k"), (1, "plain words of a text", "en", "a", 1, "k"), (None, None, None, None, None, None)]
    data += [(None, "other words than those", None, None, 3, "k"), (4, "", "en", "a", 0, None), (5, "long " * 100_000, "en", "b", 2, "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, shard string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
            assert name == "sharding" or frame.columns == docs.columns
        assert frame.columns == [*docs.columns[:-1], "slot", "shard"]
        frame.collect()


def test_corpus_without_languages(spark, docs):
    """Nothing to learn from: texts with a letter stay."""
    frame = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    got = Counter(r["doc_id"] for r in corpus_pipeline.identify_language(spark, frame, SF).collect())
    assert got == Counter(d["doc_id"] for d in docs if d["text"] and any(map(str.isalpha, d["text"])))


def test_language_is_filled_in_and_chosen(spark, docs, monkeypatch):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    named = frame.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    truth = {d["doc_id"]: d["lang"] for d in docs if d["lang"]}
    rows = corpus_pipeline.identify_language(spark, named, SF).collect()
    assert all(r["lang"] for r in rows)
    filled = [r for r in rows if r["doc_id"] in truth and r["doc_id"] % 3 == 0]
    assert filled and sum(r["lang"] == truth[r["doc_id"]] for r in filled) >= 0.9 * len(filled)
    monkeypatch.setattr(corpus_pipeline, "WANTED_LANGUAGES", ("en",))
    only = corpus_pipeline.identify_language(spark, frame, SF).collect()
    assert 0 < len(only) < len(rows)
