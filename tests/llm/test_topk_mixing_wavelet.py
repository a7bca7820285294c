"""Exact top-k, mixing, token files."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempora.llm import arrays as A
from tempora.llm import mixing, topk
from tempora.llm import wavelet as V
from tempora.llm.bpe import Encoder

from .helpers import frame, prose

# top-k


def brute(rows, queries, k):
    out = {}
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, v in whole:
        if i in queries:
            found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in whole if j != i and len(w) == len(v))[:k]
            out[i] = [(r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return out


@pytest.mark.parametrize("blocks", [(4096, 1024), (16, 4)])
def test_top_k_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "CANDIDATES", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=40) * (3 if i % 9 == 0 else 0.3)]) for i in range(150)]
    rows += [(200 + i, rows[9][1]) for i in range(6)]  # ties
    rows += [(300, None), (301, [float("nan")] * 40), (302, [float("inf")] + [0.0] * 39), (303, [None] + [0.0] * 39), (304, [1.0, 2.0]), (305, []), (306, [1e13] * 40), (None, [1.0] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    queries = {i for i, _ in rows if i is not None and i % 5 == 0}
    found = defaultdict(list)
    for r in topk.top_k(df, df.where("vec_id % 5 = 0")).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    expected = {q: [(a, b, max(-(2**63), min(2**63 - 1, s))) for a, b, s in v] for q, v in brute(rows, queries, 5).items() if v}
    assert dict(found) == expected


def test_bounds_drop_candidates_but_no_answers():
    rng = np.random.default_rng(2)
    matrix = np.floor(rng.normal(size=(64, 3000)) * 20)
    matrix[:, 5:20] *= 30
    sums = np.add.reduceat(matrix**2, np.arange(0, 64, 16), axis=0)
    rests = np.sqrt(np.concatenate([np.cumsum(sums[::-1], axis=0)[::-1], np.zeros((1, 3000))]))
    for q in range(20):
        ids, scores = topk.search_block(np.arange(3000), matrix, rests, q, matrix[:, q].copy(), 5)
        every = matrix[:, q] @ matrix
        every[q] = -np.inf
        best = np.lexsort([np.arange(3000), -every])[:5]
        assert ids.tolist() == best.tolist() and scores.tolist() == every[best].tolist()


def test_blocks_of_small_norms_are_not_paired(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "STEPS", 5)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=24) * 0.8 ** (i // 10)]) for i in range(400)]
    rows += [(1000 + i, [1e306] + [0.0] * 23) for i in range(2)]  # not finite when scaled
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = df.where("vec_id % 5 = 0")
    assert topk.block_pairs(df, queries, 5, "vec_id", "embedding", 256.0).count() < 0.7 * 25 * 20
    out = topk.top_k(df, queries)
    found = defaultdict(list)
    for r in out.orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert dict(found) == brute(rows[:400], {i for i, _ in rows if i % 5 == 0 and i < 400}, 5)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, df).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, one).count() == 0


# mixing


def fill(sizes):
    """Targets by raising the level until nothing is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        level = left / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def mixed_texts():
    rng = random.Random(4)
    return [(k, " ".join(["w"] * rng.randrange(0, 60)), None if k % 17 == 0 else f"src{min(rng.randrange(30), 9)}") for k in range(900)] + [(5000, None, "empty"), (5001, "", "empty"), (None, "a b", "src1")]


def test_mix_meets_its_targets(spark):
    df = spark.createDataFrame(mixed_texts(), "doc_id long, text string, source string").withColumn("size", mixing.word_count("text"))
    rows = mixing.mix_copies(df.withColumn("target", F.lit("clash"))).collect()
    assert len(rows) == len(mixed_texts())
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    targets = fill(sizes)
    taken = Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 3 * 60, s
    again = mixing.mix_copies(df.repartition(7)).collect()
    assert Counter((r["doc_id"], r["copies"]) for r in again) == Counter((r["doc_id"], r["copies"]) for r in rows)


def test_mix_repeats_whole_rows(spark):
    df = spark.createDataFrame(mixed_texts(), "doc_id long, text string, source string")
    df = df.unionByName(df.where("doc_id = 3"))
    out = mixing.mix(df.withColumn("copies", F.lit("clash")))
    assert out.columns == ["doc_id", "text", "source", "copies"]
    n = Counter(r["doc_id"] for r in out.collect())
    assert n[3] <= 4 and max(v for k, v in n.items() if k != 3) <= 2
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_ranks_rows_that_repeat_one_by_one_and_takes_any_columns(spark):
    rows = [(1, "a b c", "s", {"k": 1}, 2.5)] * 400 + [(2, "d e f", "s", None, 1.0), (None, None, None, {}, None), (7, "q", "t", {"z": 0}, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, m map<string,int>, `x.y` double")
    out = mixing.mix(df)
    assert out.columns == df.columns
    n = Counter(r["doc_id"] for r in out.collect())
    # target: 1.5 times all words, but no more than twice the source's; s has nearly all of them
    assert 590 <= n[1] <= 612 and n[2] <= 2 and n[7] <= 2
    again = Counter(r["doc_id"] for r in mixing.mix(df.repartition(3)).collect())
    assert n == again


# token files

BPE = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aZ.'s,!<|é \n\t0_"), st.characters(blacklist_categories=["Cs"]))), min_size=1, max_size=5))
def test_ids_equal_those_of_whole_texts(texts):
    whole = Tokenizer.from_file(BPE)
    ids, counts = Encoder.kept(BPE).rows(*A.utf8(pa.array([*texts, "don't <|endoftext|>x <|ENDOFTEXT|> it's."], pa.string())))
    for t, found in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=False):
        assert found.tolist() == whole.encode(t, add_special_tokens=False).ids


def test_planes_of_more_ids_than_move_at_a_time():
    rng = np.random.default_rng(3)
    for n in (V.STEP - 1, V.STEP, V.STEP + 1, 2 * V.STEP + 77):
        ids = rng.integers(0, 49_000, n).astype(np.uint16)
        w = V.unpack(V.pack([1], np.array([n]), ids, 16))[2]
        assert (w.ids() == ids).all()
        order, expected = ids.copy(), []
        for b in range(15, -1, -1):
            one = order >> b & 1 == 1
            expected.append((int((~one).sum()), np.packbits(one)))
            order = np.concatenate([order[~one], order[one]])
        assert all(z == x and (p == y).all() for z, p, (x, y) in zip(w.zeros, w.planes, expected, strict=True))
        assert w.access(n - 1) == ids[-1] and w.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500), st.integers(6, 9))
def test_wavelet_matrix_equals_the_list(values, bits):
    ids = np.array(values, np.uint16)
    _, _, w = V.unpack(V.pack([1], np.array([len(ids)]), ids, bits))
    assert w.ids().tolist() == values
    for p in range(0, len(values), 97):
        assert w.access(p) == values[p]
    for t in set(values[:5]) | {41, 1 << 12}:
        at = [i for i, v in enumerate(values) if v == t]
        assert w.count(t) == len(at) and w.occurrences(t) == at and w.rank(t, len(values) // 2) == sum(i < len(values) // 2 for i in at)


def test_large_ids_and_bounds():
    ids = np.array([70_000, 3, 70_000], np.uint32)
    w = V.WaveletMatrix.build(ids, 17)
    assert w.ids().tolist() == [70_000, 3, 70_000] and w.select(70_000, 1) == 2
    with pytest.raises(IndexError):
        w.access(3)
    with pytest.raises(IndexError):
        w.select(3, 1)


def test_files_hold_all_documents_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "SHARD_TOKENS", 300)
    texts = [prose(30 + k, k) for k in range(60)] + ["", None, "END."]
    df = frame(spark, texts).repartition(5).withColumnRenamed("lang", "start")
    manifest = V.write_shards(df, f"file://{tmp_path}", BPE, 2)
    assert manifest.count() >= 8
    whole, start = Tokenizer.from_file(BPE), 0
    rows = {r["doc_id"]: r for r in V.read_digests(manifest).collect()}
    full = {r["doc_id"]: r["ids"] for r in V.read_shards(manifest).collect()}
    for k, t in enumerate(texts):
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        assert full[k] == ids
        assert (rows[k]["start"], rows[k]["n_tokens"], rows[k]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert V.find(manifest, 2).count() == len(texts)


def test_token_files_of_odd_tables(spark, tmp_path):
    assert V.read_digests(V.write_shards(frame(spark, []), f"{tmp_path}/a", BPE, 2)).count() == 0
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    rows = V.read_digests(V.write_shards(df, f"{tmp_path}/b", BPE, 2)).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 1]


def test_shards_of_null_ids_share_a_task_with_others(spark, tmp_path):
    df = spark.createDataFrame([(None, f"a{k}") for k in range(40)] + [(k, "b") for k in range(40)], "doc_id long, text string")
    manifest = V.write_shards(df, f"{tmp_path}/c", BPE, 2)
    rows = V._read(manifest, "long", "ids_crc32 long", tasks=1).collect()
    assert manifest.count() > 1 and Counter(r["doc_id"] for r in rows) == {None: 40, **dict.fromkeys(range(40), 1)}
    assert V.read_shards(manifest).count() == 80


def test_very_long_and_blank_texts_in_token_files(spark, tmp_path):
    texts = [prose(60_000, 1), "x" * 300_000, " \n" * 1000]
    whole = Tokenizer.from_file(BPE)
    rows = {r["doc_id"]: r["ids"] for r in V.read_shards(V.write_shards(frame(spark, texts), f"{tmp_path}/d", BPE, 2)).collect()}
    assert all(rows[k] == [*whole.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(texts))
