"""Repeated windows against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from tempora.llm import substring as S

from .helpers import frame, prose


def brute(texts):
    w = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(x[i : i + 35]) for x in w for i in range(len(x) - 34))
    out = {}
    for k, x in enumerate(w):
        gone = [False] * len(x)
        for i in range(len(x) - 34):
            if seen[tuple(x[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        out[k] = (len(x), sum(gone), [a for a, g in zip(x, gone, strict=True) if not g])
    return out


def texts():
    passage, other = prose(60, 1), prose(35, 2)
    shared = [f"{prose(5 + 3 * k, 10 + k)} {passage} {prose(7, 40 + k)}" for k in range(25)]  # every alignment modulo the period
    return [*shared, prose(50, 90) + "\n" + other, other + "\t" + prose(3, 91), prose(34, 92), prose(34, 92), "x " * 36, "x " * 35, "y " * 35, "", None, "  \x0b ", prose(400, 93), prose(400, 93), f"a b {other} c"]


def test_words_equal_brute_force(spark):
    t = texts()
    found = {r["doc_id"]: r for r in S.remove_repeats(frame(spark, t), keep_text=False).collect()}
    for k, (n, gone, kept) in brute(t).items():
        assert (found[k]["n_words"], found[k]["n_removed"]) == (n, gone), k
        assert found[k]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest(), k


def test_texts_without_repeats_stay_as_they_are(spark):
    t = texts()
    df = frame(spark, t)
    out = S.remove_repeats(df)
    assert out.columns[: len(df.columns)] == df.columns
    expected = brute(t)
    for r in out.collect():
        n, gone, kept = expected[r["doc_id"]]
        assert r["text"] == (" ".join(kept) if gone else t[r["doc_id"]])


def test_empty_table_null_ids_and_clashing_columns(spark):
    assert S.remove_repeats(frame(spark, [])).count() == 0
    df = spark.createDataFrame([(None, prose(40, 1), "clash"), (None, prose(40, 1), "clash"), (7, prose(40, 2), "clash")], "doc_id long, text string, n_words string")
    rows = S.remove_repeats(df).collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in rows) == [(40, 0), (40, 40), (40, 40)]


def test_cover_meets_every_pair_of_alignments():
    for i in range(S.PERIOD):
        for j in range(S.PERIOD):
            assert any((i + d) % S.PERIOD in S.COVER and (j + d) % S.PERIOD in S.COVER for d in range(S.PERIOD))
    assert S.ANCHOR + S.PERIOD - 1 == S.WIDTH


@pytest.mark.parametrize("ranges", [1, 3, 64, 5_000_000])
def test_ranges_get_every_hash_and_answer_the_chunks_that_hold_it(ranges):
    hashes = {4: [0, 5, 5, 5, 2**63, 2**64 - 1], 9: [7, 2**63, 7 << 40], 11: []}
    found = [S.sent(np.array(h, np.uint64), c, ranges) for c, h in hashes.items()]
    # never more messages than hashes, however many ranges there are
    assert [len(x) for x in found] <= [5, 3, 0] and sum(len(x) for x in found) <= 8
    rows = pa.Table.from_batches(found)
    answers = Counter()
    for r in set(rows["range"].to_pylist()):
        one = S.repeated(rows.filter(pa.compute.equal(rows["range"], r)))
        for c, b in zip(one["chunk"].to_pylist(), one["hashes"].to_pylist(), strict=True):
            answers.update((c, x) for x in set(np.frombuffer(b, np.uint64).tolist()))
    assert answers == Counter({(4, 5): 1, (4, 2**63): 1, (9, 2**63): 1})


def test_small_chunks_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", 500)
    t = [*texts(), prose(30_000, 7), f"{prose(20_000, 8)} {prose(60, 1)} {prose(20, 9)}"]
    df = frame(spark, t)
    chunks = [r["__chunk"] for r in S._chunked(df, "text").collect()]
    assert len(set(chunks)) > 10
    found = {r["doc_id"]: r for r in S.remove_repeats(df, keep_text=False).collect()}
    for k, (n, gone, kept) in brute(t).items():
        assert (found[k]["n_words"], found[k]["n_removed"]) == (n, gone), k
        assert found[k]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest(), k


def test_maps_dots_and_other_text_columns(spark):
    df = spark.createDataFrame([(prose(40, 1), {"a": 1}, 2), (prose(40, 1), None, 3), (prose(9, 2), {}, None)], "body string, m map<string,int>, `x.y` int")
    out = S.remove_repeats(df, "body")
    assert out.columns == ["body", "m", "x.y", "n_words", "n_removed"]
    assert sorted((r["x.y"] or 0, r["m"], r["body"], r["n_removed"]) for r in out.collect()) == [(0, {}, prose(9, 2), 0), (2, {"a": 1}, "", 40), (3, None, "", 40)]


def test_tables_read_from_files_are_not_copied(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_ROWS", 4)
    t = texts()
    frame(spark, t).repartition(6).write.parquet(f"{tmp_path}/docs")
    df = spark.read.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(S, "spread", lambda x: x)
    assert len({r["__chunk"] for r in S._chunked(df, "text").collect()}) >= 9
    found = {r["doc_id"]: r for r in S.remove_repeats(df, keep_text=False).collect()}
    for k, (n, gone, kept) in brute(t).items():
        assert (found[k]["n_words"], found[k]["n_removed"]) == (n, gone), k
        assert found[k]["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest(), k
    twice = df.unionByName(df.where("doc_id = 25"))  # no table of files, but a union of two
    assert {r["n_removed"] for r in S.remove_repeats(twice, keep_text=False).where("doc_id = 25").collect()} == {85}
