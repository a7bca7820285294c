"""Near duplicates against brute force over all pairs."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tempora.llm import components as C
from tempora.llm import minhash as M

from .helpers import SCHEMA, frame, prose, words


def brute(texts):
    w = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    s = [Counter(tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))) if x else Counter() for x in w]
    df = Counter(t for x in s for t in x)
    n = sum(1 for x in s if x)
    v = [{t: (1 + math.log(c)) * (1 + math.log(max(df[t] / n, M.RARE)) / math.log(M.RARE)) for t, c in x.items()} for x in s]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if v[a] and v[b]:
            shared = sum(min(v[a][t], v[b][t]) for t in v[a].keys() & v[b].keys())
            if shared / (sum(v[a].values()) + sum(v[b].values()) - shared) >= 0.8:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in range(len(texts))}


def corpus():
    rng = random.Random(5)
    texts = [prose(80, k) for k in range(12)]
    for k in range(4):  # copies with few and with many changes
        for changes in (0, 1, 1, 2, 3, 6, 12, 30):
            w = words(80, k)
            for at in rng.sample(range(80), changes):
                w[at] = f"new{rng.random()}"
            texts.append(" ".join(w))
    texts += ["", None, "   ", "short one", "short one", "a b c d e", "a b c d e f", "x " * 300, "x " * 300]
    return texts


def test_classes_equal_brute_force(spark):
    texts = corpus()
    found = M.near_duplicates(frame(spark, texts))
    assert found.columns == ["doc_id", "class_id"]
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == brute(texts)


@pytest.mark.parametrize(("block", "hubs"), [(3, 1), (3, 0), (2, 40)])
def test_large_clusters_are_cut_into_blocks_without_losing_links(spark, monkeypatch, block, hubs):
    texts = corpus()
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(M, "HUBS", hubs)
    assert {r["doc_id"]: r["class_id"] for r in M.near_duplicates(frame(spark, texts)).collect()} == brute(texts)


def test_variants_of_a_template_in_many_blocks(spark, monkeypatch):
    template = words(120, 1)
    texts = [" ".join(template[:60] + words(70, 100 + k) + template[60:]) for k in range(120)]
    texts += [t.rsplit(" ", 1)[0] + " end" for t in texts[::10]]
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "HUBS", 6)
    met = []
    across = M._across
    monkeypatch.setattr(M, "_across", lambda *a: met.append(across(*a)) or met[-1])
    found = {r["doc_id"]: r["class_id"] for r in M.near_duplicates(frame(spark, texts)).collect()}
    assert found == brute(texts) and len(set(found.values())) == 120 and len(met) == 1


def vector(weights):
    ids = np.array(sorted(weights), np.uint64)
    w = np.array([weights[i] for i in ids.tolist()], np.float32)
    return ids, w, float(w.sum(dtype=np.float64))


def test_prefixes_of_similar_vectors_meet_and_those_of_variants_do_not():
    rng = random.Random(2)
    known = np.arange(0, 300, 2, dtype=np.uint64)
    counts = np.array([rng.randrange(1, 9) for _ in known])
    for _ in range(300):
        a = {rng.randrange(300): rng.uniform(1, 4) for _ in range(rng.randrange(1, 60))}
        b = {k: v * rng.choice([1, 1, 1, 1.2]) for k, v in a.items() if rng.random() > 0.1} or a
        b |= {rng.randrange(300): 1.0 for _ in range(rng.randrange(4))}
        x, y = vector(a), vector(b)
        if M.similarity(x, y) >= 0.8:
            assert set(M.prefix(x, known, counts, 0.8).tolist()) & set(M.prefix(y, known, counts, 0.8).tolist())
    template = dict.fromkeys(range(100), 1.0)
    variants = [vector(template | dict.fromkeys(range(1000 * k, 1000 * k + 50), 1.0)) for k in range(1, 30)]
    known, counts = np.unique(np.concatenate([v[0] for v in variants[:5]]), return_counts=True)
    firsts = [set(M.prefix(v, known, counts, 0.8).tolist()) for v in variants[5:]]
    assert sum(map(len, firsts)) == len(set().union(*firsts))


def test_links_follow_exact_document_frequencies_when_the_sketch_is_full(spark, monkeypatch):
    texts = []
    for k in range(16):  # a common and a rare half; changes in the rare one weigh more than the full row tells
        common, rare = words(60, 100), words(60, 200 + k)
        texts.append(" ".join(common + rare))
        rare[20 : 24 + k % 5] = [f"new{k}x{x}" for x in range(4 + k % 5)]
        texts.append(" ".join(common + rare))
    monkeypatch.setattr(M, "WIDTH", M.SEGMENTS)
    monkeypatch.setattr(M, "GATHER", 500)
    assert {r["doc_id"]: r["class_id"] for r in M.near_duplicates(frame(spark, texts)).collect()} == brute(texts)


def test_empty_table_extra_columns_and_repeated_rows(spark):
    assert M.near_duplicates(frame(spark, [])).count() == 0
    text = prose(50, 1)
    df = frame(spark, [text, text, prose(50, 2)]).withColumn("class_id", F.lit("clash"))
    again = df.unionByName(df.where("doc_id = 2"))
    assert sorted((r["doc_id"], r["class_id"]) for r in M.near_duplicates(again).collect()) == [(0, 0), (1, 0), (2, 2), (2, 2)]
    kept = M.keep_first(again)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2]


def test_null_ids_count_only_where_a_group_has_no_other(spark):
    a, b = prose(50, 1), prose(50, 2)
    near = b.rsplit(" ", 1)[0] + " changed"
    rows = [(None, a), (3, a), (4, prose(50, 3)), (None, b), (0, near), (None, prose(50, 4)), (None, ""), (None, None)]
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == Counter({(None, 3): 1, (3, 3): 1, (4, 4): 1, (None, 0): 1, (0, 0): 1, (None, None): 3})


def test_many_rows_without_ids_and_a_very_long_text(spark):
    long = prose(40_000, 9)
    rows = [(None, prose(30, k % 20)) for k in range(200)] + [(5, long), (6, long + " more"), (7, "x" * 200_000)]
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == Counter({(None, None): 200, (5, 5): 1, (6, 5): 1, (7, 7): 1})
    assert M.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).count() == 22


def test_weights_depend_on_shares_of_texts(spark, monkeypatch):
    texts = [f"{prose(40, 7)} {prose(30, 100 + k)}" for k in range(50)]
    monkeypatch.setattr(M, "RARE", 0.1)
    for times in (1, 4):  # the same shares in a table of four times the size
        df = frame(spark, texts * times).select(F.col("text").alias("__text"))
        n, rare, ids, counts, _ = M.frequent_shingles(df)
        assert (n, rare) == (50 * times, 0.1) and set((counts / n).tolist()) == {1.0} and len(ids) == 36
        weights = M.Weights(n, rare, ids, counts)
        assert weights.idf(ids).tolist() == [1.0] * 36 and weights.idf(ids + np.uint64(1)).tolist() == [2.0] * 36


def test_one_row_of_each_group_is_kept(spark, tmp_path):
    a, b, c = (prose(60, k) for k in (1, 2, 3))
    near = a.rsplit(" ", 1)[0] + " changed"
    texts = [(2, a), (2, a), (7, near), (5, b), (5, c), (3, c), (None, b), (None, b), (None, prose(60, 4)), (8, ""), (9, None)]
    df = spark.createDataFrame([(i, t, "en", f"s{k}", 1) for k, (i, t) in enumerate(texts)] + [(2, a, "en", "s0", 1)], SCHEMA).withColumn("group", F.lit("clash")).withColumn("m", F.create_map(F.lit("k"), F.col("n_chars")))
    kept = M.keep_first(df)
    assert kept.columns == df.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(2, a), (3, c), (None, b), (None, prose(60, 4)), (8, ""), (9, None)])
    df.repartition(3).write.parquet(f"{tmp_path}/docs")
    again = spark.read.parquet(f"{tmp_path}/docs")
    for table in (again, again.unionByName(again), again.where("doc_id is not null").select("text", "doc_id", "m")):
        rows = Counter((r["doc_id"], r["text"]) for r in M.keep_first(table).collect())
        assert set(rows) - {(None, b), (5, b), (None, prose(60, 4))} == {(2, a), (3, c), (8, ""), (9, None)} and all(n == 1 for (i, t), n in rows.items() if t)
    stage = corpus_pipeline.near_dedup(spark, df.where("doc_id = 2"), "")
    assert [(r["doc_id"], r["text"]) for r in stage.collect()] == [(2, a)]


def test_samples_agree_as_often_as_weighted_jaccard_says():
    rng = np.random.default_rng(1)
    a_ids = np.sort(rng.choice(1 << 40, 60, replace=False).astype(np.uint64))
    weights = rng.uniform(1, 3, 60).astype(np.float32)
    other = weights.copy()
    other[:15] *= 2.5
    b_ids, b_weights = a_ids[:-10], other[:-10]
    shared = float(np.minimum(weights[:-10], b_weights).sum())
    truth = shared / (weights.sum() + b_weights.sum() - shared)
    _, a = M.samples(np.zeros(60, np.int64), a_ids, weights, 4000)
    _, b = M.samples(np.zeros(50, np.int64), b_ids, b_weights, 4000)
    assert abs((a == b).mean() - truth) < 0.03
    assert M.similarity((a_ids, weights, float(weights.sum())), (b_ids, b_weights, float(b_weights.sum()))) == pytest.approx(truth, rel=1e-5)


@pytest.mark.parametrize("limit", [4_000_000, 10])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(C, "TASK_EDGES", limit, raising=False)
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert {r["node"]: r["root"] for r in C.components(df).collect()} == {x: find(x) for x in linked}
