"""The pipeline's stages and the registered queries."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import near_dedup, packing, quality_classifier, quality_rules, queries

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(queries.SQL) <= set(names)


def test_license_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    got = sorted(tuple(r) for r in queries.op8_licenses(spark, FOLDER).collect())
    assert got == sorted(con.execute(queries.SQL["op8_licenses"]).fetchall()) != []


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(10**9, None, None, None, None), (None, "", "en", "s", 0)], docs.schema)
    docs = docs.union(odd).union(docs.limit(5)).withColumn("kept", F.lit(1))
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns, count = docs.columns, docs.count()
        docs = corpus_pipeline.settle(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == columns
        assert 0 < docs.count() < count if name != "quality rules" else docs.count() <= count
        before = docs
    packed = corpus_pipeline.STAGES[-1][1](spark, before, FOLDER)
    assert packed.select("doc_id").distinct().count() == before.count()


def test_labelled_good_documents_survive_the_filters(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = corpus_pipeline.settle(stage(spark, docs, folder), "stage")
    left = docs.join(labels, "doc_id")
    assert left.where("quality = 0").count() == 0
    assert left.where("quality = 1").count() >= 0.9 * labels.where("quality = 1").count()


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, FOLDER), "stage")
    assert docs.count() == 0


def test_run_equals_the_stages_done_plainly(spark):
    """``run`` row by row: operators' verdicts per document, all pairs of shingle sets, the library's tokens."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    frame = lambda rows: spark.createDataFrame(list(rows), spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = quality_classifier.quality_scores(frame(docs.values()), labels).collect()
    docs = {r["doc_id"]: docs[r["doc_id"]] for r in scores if r["score"] >= 0.3}
    ruled = quality_rules.quality_rules(frame(docs.values())).collect()
    docs = {r["doc_id"]: docs[r["doc_id"]] for r in ruled if r["kept"]}
    sets = {}
    for i, r in docs.items():
        words = re.findall("[^\x20\x09-\x0d]+", (r["text"] or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    kept = {i for i in docs if find(i) == i}
    assert 0 < len(kept) < len(docs)
    byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i in kept:
        ids = byte.encode(docs[i]["text"] or "", add_special_tokens=False).ids + [0]
        bounds = packing.cut(len(ids))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= packing.CAPACITY


def test_clashing_columns_and_repeated_ids_in_the_filters(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    own = ("__d_id", "__c_score", "gone_id", "row", "digest", "score", "n_words", "__q_kept", "__q_cell", "__q_own0")
    for name in own:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    again = docs.limit(3).withColumn("text", F.concat(F.lit("another text "), F.reverse("text")))
    docs = corpus_pipeline.settle(docs.union(again), "clash")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality_classifier.kept_documents(docs, labels)
    assert scored.columns == docs.columns and set(r[0] for r in scored.select("__c_score").collect()) == {"own __c_score"}
    passed = quality_rules.kept_documents(docs)
    assert passed.columns == docs.columns and passed.count()
    assert {tuple(r) for r in passed.select(*own).collect()} == {tuple(f"own {name}" for name in own)}
    one = near_dedup.kept_documents(docs)
    assert one.columns == docs.columns and {r["digest"] for r in one.collect()} == {"own digest"}
    texts = {r["doc_id"]: r["text"] for r in one.collect()}
    assert len(texts) == one.count()
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for i, text in texts.items():
        assert digest(text) == min(digest(r["text"]) for r in docs.where(F.col("doc_id") == i).collect())


def test_scores_do_not_depend_on_neighbouring_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_classifier.fit(docs, labels)
    rows = quality_classifier.with_score(docs.select("doc_id", "text"), model, "score").collect()
    data = [np.frombuffer((r["text"] or "").encode(), np.uint8) for r in rows]
    for r, text in list(zip(rows, data))[:40]:
        features, row = quality_classifier.passages(text, np.array([0, len(text)]))
        assert r["score"] == pytest.approx(float(model.score(features, row, 1)[0]), abs=1e-9)


def test_attention_equals_a_plain_forward_pass(spark):
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, quality_classifier.FEATURES)) for n in (1, 3, 7, 2)]
    model = quality_classifier.train(bags * 4, [0, 1, 1, 0] * 4)
    x = (np.concatenate(bags) - model.mean) / model.scale
    got = quality_classifier.forward(model.weights, x, np.repeat(np.arange(4), [len(b) for b in bags]), 4)["score"]
    w = model.weights
    for bag, score in zip(bags, got):
        raw, hidden = [], []
        for passage in (bag - model.mean) / model.scale:
            h = [math.tanh(sum(passage[i] * w["w"][i, j] for i in range(len(passage))) + w["b"][j]) for j in range(w["w"].shape[1])]
            value = 0.0
            for g in range(w["v"].shape[1]):
                t = math.tanh(sum(h[j] * w["v"][j, g] for j in range(len(h))))
                s = 1 / (1 + math.exp(-sum(h[j] * w["u"][j, g] for j in range(len(h)))))
                value += t * s * w["a"][g]
            raw.append(value)
            hidden.append(h)
        total = sum(math.exp(v) for v in raw)
        pooled = [sum(math.exp(v) / total * h[j] for v, h in zip(raw, hidden)) for j in range(len(hidden[0]))]
        logit = sum(p * c for p, c in zip(pooled, w["c"])) + float(w["d"])
        assert score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9)
