"""Digests: features by brute force, likeness, edits and order."""

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.llm import arrays as A
from tempora.llm import fingerprint as P

from .helpers import frame, prose


def one(text):
    return P.digests(*A.utf8(pa.array([text])))[0]


@settings(max_examples=40, deadline=None)
@given(st.text(st.sampled_from("abcde é\n"), min_size=0, max_size=150))
def test_ranks_equal_brute_force(text):
    raw = text.encode()
    pad = b"\xff" * P.FEATURE
    data = np.frombuffer(pad + raw + pad, np.uint8)
    found = P.ranks(data)
    for k in range(len(found)):
        window = bytes(data[k : k + P.FEATURE])
        if 0xFF in window:
            assert found[k] == P._NONE
            continue
        e = -sum(c / P.FEATURE * math.log2(c / P.FEATURE) for c in Counter(window).values())
        if e < P.LEAST - 1e-3:
            assert found[k] == P._NONE
        elif e > P.LEAST + 1e-3:
            assert abs(found[k] - (1000 - min(round(abs(e - P.TYPICAL) * 400), 1000))) <= 1


def test_a_digest_depends_on_its_text_alone():
    texts = [prose(n, n) for n in (3, 10, 200, 900)] + ["", "x"]
    together = P.digests(*A.utf8(pa.array(texts)))
    for t, d in zip(texts, together, strict=True):
        assert (one(t) == d).all()
    assert len(together[3]) > 1 and all(len(d) >= 1 for d in together)


def test_likeness():
    a, b = prose(600, 1), prose(600, 2)
    edited = a[: len(a) * 3 // 4] + b[: len(a) // 4]
    assert P.likeness(one(a), one(a)) == 1.0
    assert P.likeness(one(a), one(b)) < 0.1 < 0.5 < P.likeness(one(a), one(edited))
    assert P.likeness(one(a), one(b)) == P.likeness(one(b), one(a))
    assert P.likeness(one(""), one("")) == 1.0 and 0 <= P.likeness(one(""), one(a)) <= 1
    assert P.likeness(one("short text here"), one("short text hers")) > 0.3


def test_edits_follow_the_order_of_ids(spark):
    texts = [prose(60, k) for k in range(40)] + ["", None, "é" * 9, "four"]
    df = frame(spark, texts).orderBy("text")
    found = {r["doc_id"]: r for r in P.compare_with_edits(df).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        text, following = text or "", texts[(k + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        r = found[k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == P.text_of(one(text)) and r["edited_fingerprint"] == P.text_of(one(edited))
        assert r["near_edited"] == P.likeness(one(text), one(edited)) and r["near_next"] == P.likeness(one(text), one(following))


def test_small_tables_nulls_repeats_and_clashes(spark):
    assert P.compare_with_edits(frame(spark, [])).count() == 0
    alone = P.compare_with_edits(frame(spark, ["only one text here"])).first()
    assert alone["near_next"] == 1.0
    df = spark.createDataFrame([(None, "a"), (1, "bb"), (1, "bb"), (1, "bb")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in P.compare_with_edits(df).collect()) == ["1", "1", "1", "None"]
    out = P.fingerprints(frame(spark, ["x", None]).withColumnRenamed("lang", "fingerprint"))
    assert [r["fingerprint"] for r in out.orderBy("doc_id").collect()] == [P.text_of(one("x")), P.text_of(one(""))]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5)), max_size=12), st.lists(st.tuples(st.integers(-1, 5), st.integers(-1, 6)), max_size=12))
def test_ranges_before_counts_bounds(bounds, rows):
    bounds = sorted(set(bounds))
    b, r = np.array(bounds, np.int64).reshape(-1, 2), np.array(rows, np.int64).reshape(-1, 2)
    assert P.ranges_before(b[:, 0], b[:, 1], r[:, 0], r[:, 1]).tolist() == [sum(x <= y for x in bounds) for y in rows]


def test_rows_without_ids_are_dealt_by_their_texts(spark, monkeypatch):
    texts = [prose(20, k) for k in range(150)] + ["long " + prose(30_000, 5)]
    df = spark.createDataFrame([(None if k < 140 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    order = df.withColumn("h", F.xxhash64("text")).orderBy(F.col("doc_id").asc_nulls_first(), "h").collect()
    expected = Counter()
    for k, r in enumerate(order):
        following, cut = order[(k + 1) % len(order)]["text"], len(r["text"]) // 4
        expected[r["doc_id"], hashlib.sha256((r["text"][: len(r["text"]) - cut] + following[:cut]).encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in P.compare_with_edits(df).collect()) == expected
