"""Quality rules and toxicity: held-out accuracy, compiled rules, offending sentences."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tempora.llm import labelled, quality, toxicity

from .helpers import frame, prose, words


def bad(k):
    w = words(60, k)
    return [" ".join(x + "***" for x in w), " ".join(w).upper() + "!!", " ".join(x for x in w[:8] for _ in range(9)), " | ".join(w)][k % 4]


@pytest.fixture(scope="module")
def texts():
    return [bad(k) if k % 3 == 0 else prose(60 + k % 50, k) + "." for k in range(600)]


@pytest.fixture(scope="module")
def labels(spark, texts):
    return spark.createDataFrame([(k, int(k % 3 > 0), int(k % 5 == 0)) for k in range(len(texts)) if k % 7], "doc_id long, quality int, toxic int")


def test_quality_on_the_held_out_fold(spark, texts, labels):
    df = frame(spark, texts)
    model = quality.train(df, labels, modulus=3, held=1)
    assert 0 < len(model.rules) < 200
    rows = quality.score(df.withColumn("score", F.lit("clash")), model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in held)
    assert len(held) > 100 and right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_compiled_rules_score_as_the_model_does(spark, texts, labels):
    df = frame(spark, texts[:80] + ["", None])
    model = quality.train(frame(spark, texts), labels)
    stats = quality.statistics("text")
    table = df.select("doc_id", *[s.alias(n) for n, s in stats.items()]).orderBy("doc_id").toPandas()
    expected = model.predict(table[list(stats)].to_numpy(float))
    found = [r["score"] for r in quality.score(df, model).orderBy("doc_id").collect()]
    assert np.allclose(found, expected) and found[-1] == found[-2]
    plan = quality.score(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_degenerate_labels(spark, texts, labels):
    df = frame(spark, texts[:20])
    only = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))
    assert quality.train(df, only).predict(np.zeros((1, len(quality.statistics("text")))))[0] > 0.99
    assert quality.train(df, labels.limit(0)).predict(np.zeros((1, len(quality.statistics("text")))))[0] == 0.5
    assert max(r["score"] for r in toxicity.score(df, toxicity.train(df, only)).collect()) < 1e-6
    assert max(r["score"] for r in toxicity.score(df, toxicity.train(df, labels.limit(0))).collect()) < 1e-6


def test_sample_is_bounded_and_leaves_out_the_fold(spark, texts, labels):
    df = frame(spark, texts)
    got = labelled.sample(df, labels, "toxic", "doc_id", 4, 2, most=50).collect()
    assert len(got) == 50 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in got)


@pytest.fixture(scope="module")
def toxic():
    rng, out = random.Random(2), []
    for k in range(700):
        sentences = [prose(9, 1000 * k + j) for j in range(6)]
        if k % 5 == 0:
            at = rng.randrange(6)
            sentences[at] = f"{prose(3, k)} you {rng.choice(['moron', 'Zurgling', 'zurgtor', 'scum,'])} {prose(3, k + 1)}"
        out.append(". ".join(sentences) + ".")
    return out


def test_toxicity_finds_held_out_documents_and_sentences(spark, toxic):
    df = frame(spark, toxic)
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(len(toxic))], "doc_id long, toxic int")
    model = toxicity.train(df, labels, modulus=4, held=2)
    rows = toxicity.score(df, model).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    found = {r["doc_id"] for r in held if r["score"] >= 0.3}
    true = {r["doc_id"] for r in held if r["doc_id"] % 5 == 0}
    assert len(found & true) / len(true) > 0.9 and len(found - true) <= 2
    told = toxicity.offending(df, model).collect()
    assert told and sum(any(x in r["text"].lower() for x in ("moron", "zurg", "scum")) for r in told) / len(told) > 0.9
    assert {r["doc_id"] for r in told} >= found & true


def test_sentences_and_edges(spark, toxic):
    weights = np.zeros(toxicity.BUCKETS, np.float32)
    df = spark.createDataFrame([(1, "One two. Three\nfour! ... five", "x"), (2, "", "x"), (None, None, "x"), (3, "no end", "x")], "doc_id long, text string, score string")
    scored = toxicity.score(df, (weights, 0.0)).collect()
    assert {r["doc_id"]: round(r["score"], 6) for r in scored} == {1: 1 - 0.5**5, 2: 0.0, None: 0.0, 3: 0.5}
    told = toxicity.offending(df, (weights, 0.0), least=0.5).where("doc_id = 1").orderBy("sentence").collect()
    assert [r["text"] for r in told] == ["One two.", "Three", "four!", "...", "five"]
    assert toxicity.score(df.limit(0), (weights, 0.0)).count() == 0


def test_lasso_weights_are_optimal():
    rng = np.random.default_rng(1)
    a = (rng.random((800, 40)) < rng.uniform(0.05, 0.6, 40)).astype(np.float32)
    a[:, 7] = a[:, 3]  # equal rules
    y = (rng.random(800) < 1 / (1 + np.exp(-(3 * a[:, 3] - 2 * a[:, 11] - 0.5)))).astype(float)
    b = (a - a.mean(0)) / a.std(0)
    w, c = quality.weigh(b, y)
    p = 1 / (1 + np.exp(-(b @ w + c)))
    assert quality.off(w, b.T @ (p - y) / len(y)) < 2 * quality.TOLERANCE and abs((p - y).mean()) < 2 * quality.TOLERANCE
    loss = lambda w, c: np.logaddexp(0, b @ w + c).mean() - (y * (b @ w + c)).mean() + quality.LASSO * np.abs(w).sum()
    best = loss(w, c)
    assert 0 < (w != 0).sum() < 40
    for _ in range(50):
        assert loss(w + rng.normal(size=40) * rng.choice([1e-3, 1e-2, 0.1]), c) >= best - 1e-7


def test_toxicity_fit_climbs_the_likelihood_of_the_noisy_or():
    rng = np.random.default_rng(2)
    n, width = 60, 5
    label = (np.arange(n) % 3 == 0).astype(np.int32)
    sentences = rng.integers(1, 6, n)
    sentence = [sorted(rng.integers(0, m, 4).tolist()) for m in sentences]
    feature = [[int(rng.integers(0, width - 1)) for _ in s] for s in sentence]
    for k in range(0, n, 3):
        feature[k][0] = width - 1
    lists = [pa.array(x, pa.list_(pa.int32())) for x in (sentence, feature)]

    def likelihood(w, bias):
        total = 0.0
        for k in range(n):
            z = [bias] * int(sentences[k])
            for s, f in zip(sentence[k], feature[k], strict=True):
                z[s] += w[f]
            clean = np.prod([1 - 1 / (1 + np.exp(-x)) for x in z])
            total += np.log(max(1 - clean, 1e-9)) if label[k] else np.log(max(clean, 1e-9))
        return total / n - 0.5e-6 * float(np.square(w).sum())

    w, bias = toxicity.fit(label, sentences, *lists, width)
    start = likelihood(np.zeros(width), -5.0)
    reached = likelihood(w, bias)
    assert reached > start and w.argmax() == width - 1
    # the gradient by finite differences: no direction of one weight climbs much further
    for k in range(width):
        step = np.zeros(width)
        step[k] = 1e-4
        assert (likelihood(w + step, bias) - likelihood(w - step, bias)) / 2e-4 < 0.02


def test_scores_of_odd_rows(spark, texts, labels):
    model = quality.train(frame(spark, texts), labels)
    long = ". ".join(prose(12, k) for k in range(4000)) + "."
    rows = [(1, long, {"a": 1}), (1, long, {"a": 1}), (None, None, None), (None, "", {}), (2, "x" * 300_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `__words` map<string,int>").withColumnRenamed("__words", "a.b")
    found = quality.score(df, model).collect()
    assert len(found) == 5 and len({r["score"] for r in found if r["doc_id"] == 1}) == 1 and len({r["score"] for r in found if r["doc_id"] is None}) == 1
    assert quality.score(df.limit(0), model).count() == 0
    plan = quality.score(df, model).where("score >= 0.5")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")  # the predicate stays above the statistics
    toxic = toxicity.train(frame(spark, texts), labels)
    scored = toxicity.score(df, toxic).collect()
    assert len(scored) == 5 and scored[0].asDict().keys() == {"doc_id", "text", "a.b", "score"}


def test_many_clean_sentences_stay_clean_where_labelled_texts_are_long_too(spark, toxic):
    clean = [t.strip(". ") for k, t in enumerate(toxic) if k % 5]
    rng = random.Random(6)
    long = [". ".join(rng.choice(clean) for _ in range(400)) for _ in range(12)]
    df = frame(spark, [*toxic, *long])
    labels = spark.createDataFrame([(k, int(k % 5 == 0 and k < len(toxic))) for k in range(len(toxic) + len(long))], "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    clean = ". ".join(clean[:300])
    rows = [(1, clean), (2, clean + ". you moron " + prose(4, 1) + ".")]
    found = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert found[1] < 0.3 < found[2]
