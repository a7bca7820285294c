"""Sampled pieces: lossless, reproducible, and drawn with the right probabilities."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.llm import arrays as A
from tempora.llm import pieces as P

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return P.Model(PATH)


def encode(model, texts, keys=None, alpha=1.0):
    data, offsets = A.utf8(pa.array(texts, pa.string()))
    ids, counts = P.encode_rows(model, data, offsets, A.row_keys(pa.array(keys or list(range(len(texts))), pa.int64())), alpha)
    return np.split(ids, np.cumsum(counts)[:-1]), ids, np.append(0, np.cumsum(counts))


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("the ▁\n\t a"), st.characters(blacklist_categories=["Cs"])), max_size=40), min_size=1, max_size=5))
def test_decoding_gives_the_text_back(texts):
    model = P.Model.kept(PATH)
    _, ids, offsets = encode(model, texts)
    assert A.strings(*model.decode(ids, offsets)).to_pylist() == texts


def test_long_words_and_batches_change_nothing(model, monkeypatch):
    texts = ["x" * 3000, "the " * 500, "é" * 700 + " end"]
    one = encode(model, texts)[1]
    monkeypatch.setattr(P, "BATCH_BYTES", 64)
    assert encode(model, texts)[1].tolist() == one.tolist()


def test_keys_decide_the_draw(model):
    text = "reproducible segmentations of words " * 5
    a, b, c = encode(model, [text] * 3, [1, 1, 2])[0]
    assert a.tolist() == b.tolist() != c.tolist()


def test_draws_follow_the_exact_distribution(model):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    weight = {sp.id_to_piece(k).replace("▁", " "): -math.log(-sp.get_score(k) + P.RANK_SHIFT) for k in range(259, model.size)}

    def paths(x):
        if not x:
            yield (), 0.0
        for n in range(1, len(x) + 1):
            if x[:n] in weight:
                for rest, p in paths(x[n:]):
                    yield (x[:n], *rest), weight[x[:n]] + p

    every = dict(paths(" thenon"))
    total = np.logaddexp.reduce(list(every.values()))
    n = 40_000
    seen = Counter(tuple(sp.id_to_piece(int(k)).replace("▁", " ") for k in x) for x in encode(model, ["thenon"] * n)[0])
    assert set(seen) <= set(every)
    assert max(abs(seen[p] / n - math.exp(v - total)) for p, v in every.items()) < 0.012


def test_columns_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (None, None, "y"), (1, "a b", "x"), (2, "", "z")], "doc_id long, text string, piece_ids string")
    out = P.decode(P.encode(df, PATH), PATH)
    assert out.columns == ["doc_id", "text", "piece_ids", "decoded"]
    rows = out.collect()
    assert sorted((r["decoded"], len(r["piece_ids"])) for r in rows if r["text"] in (None, "")) == [("", 0), ("", 0)]
    assert len({tuple(r["piece_ids"]) for r in rows if r["doc_id"] == 1}) == 1
    both = P.encode(df, PATH, decoded="decoded", drop_text=True)
    assert both.columns == ["doc_id", "piece_ids", "decoded"] and sorted(r["decoded"] for r in both.collect()) == ["", "", "a b", "a b"]
    assert P.encode(df.limit(0), PATH).count() == 0


def test_a_long_text_without_spaces_is_many_short_lattices(model):
    import random
    import time

    rng = random.Random(1)
    texts = ["".join(rng.choice("bcdfgklmnprstvwxz0123456789") for _ in range(300_000)), "\u6f22\u5b57" * 50_000]
    began = time.perf_counter()
    rows, ids, offsets = encode(model, texts)
    assert A.strings(*model.decode(ids, offsets)).to_pylist() == texts
    assert time.perf_counter() - began < 30
    assert rows[0].tolist() == encode(model, [texts[1], texts[0]], [1, 0])[0][1].tolist()


def test_encoding_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b", 1, {"k": 2}), (None, "a b", 2, None), (3, None, 3, {}), (3, "", 4, {})], "doc_id long, text string, `x.y` int, piece_ids map<string,int>")
    out = P.encode(df.withColumn("decoded", F.lit("clash")), PATH, decoded="decoded")
    assert out.columns == ["doc_id", "text", "x.y", "piece_ids", "decoded"]
    rows = {r["x.y"]: r for r in out.collect()}
    assert rows[1]["piece_ids"] == rows[2]["piece_ids"] and [rows[k]["decoded"] for k in (1, 2, 3, 4)] == ["a b", "a b", "", ""]
    assert P.encode(df.limit(0), PATH).count() == 0
    assert P.decode(out, PATH, output="again").where("again = decoded").count() == 4
