"""The registered queries against their SQL, and the pipeline against brute force."""

import os
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from tempora.llm import queries as Q
from tempora.llm import storage

from .helpers import prose

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_gives_the_rows_of_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{f}')")
    df = Q.QUERIES[name](spark, FOLDER)
    found = con.execute(Q.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(str(sorted(zip(names, row, strict=True))) for row in found.fetchall())
    assert sorted(str(sorted(r.asDict().items())) for r in df.collect()) == expected


def test_every_operator_is_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.parametrize("name", ["op5_quality_rules", "op10_toxicity", "op4_document_fingerprints", "op2_sampled_pieces"])
def test_a_row_a_document(spark, name):
    rows = Q.QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert "lossless" not in rows[0] or all(r["lossless"] for r in rows)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in pipeline.STAGES:
        kept.append(storage.stash(stage(spark, kept[-1], FOLDER)))
    assert all(k.columns == columns for k in kept[:-1]) and kept[-1].columns == [*columns, "piece_ids"]
    texts = [{r["doc_id"]: r["text"] for r in k.collect()} for k in kept]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(labels.get(k, 1) == 1 for k in texts[1]) and all(k in texts[1] for k, v in labels.items() if v == 1)
    assert len(set(texts[2].values())) == len(texts[2]) and set(texts[2].values()) <= set(texts[1].values())
    words = {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in texts[2].items()}
    seen = Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    assert set(texts[3]) == set(texts[2])
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        assert texts[3][k] == (" ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else texts[2][k])
    assert set(texts[4]) <= set(texts[3]) and kept[4].count() == kept[5].count() and kept[4].count() <= 2 * kept[3].count()


def test_run_gives_the_last_stage(spark):
    out = pipeline.run(spark, FOLDER)
    assert out.columns[-1] == "piece_ids" and out.count() > 0


def odd_tables(spark, folder, docs, labels):
    extra = "score double, copies int, class_id string, n_words int, group string, m map<string,int>, `x.y` int"
    spark.createDataFrame([(*d, 1.5, 7, "c", None, None, {"k": 1}, 3) for d in docs], f"doc_id long, text string, lang string, source string, n_chars long, {extra}").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_of_odd_rows(spark, tmp_path):
    passage = prose(50, 500)
    texts = [f"{prose(60, k)} {passage if k % 9 == 0 else prose(50, 600 + k)} {prose(20, 900 + k)}" for k in range(60)]
    docs = [(k, t, "en", f"s{k % 2}", len(t)) for k, t in enumerate(texts)]
    docs += [(0, texts[0], "en", "s0", len(texts[0]))] * 3 + [(None, texts[5] + " end", None, None, None), (None, None, None, None, None), (70, "", "en", "s1", 0), (71, "  ", None, "s1", 2), (72, prose(20_000, 72), "en", "s1", 1)]
    odd_tables(spark, str(tmp_path), docs, [(None, None, None)])
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [table]
    for _, stage in pipeline.STAGES[:-1]:
        kept.append(storage.stash(stage(spark, kept[-1], str(tmp_path))))
        assert kept[-1].columns == table.columns and [f.dataType for f in kept[-1].schema] == [f.dataType for f in table.schema]
    assert kept[1].count() == len(docs)
    groups = kept[2].collect()
    assert len(groups) == len(docs) - 4 and Counter(r["doc_id"] for r in groups)[0] == 1
    lost = {r["doc_id"] for r in kept[3].collect() if r["text"] and passage not in r["text"]} & {0, 9, 18, 27, 36, 45, 54}
    assert lost == {0, 9, 18, 27, 36, 45, 54}
    out = pipeline.STAGES[-1][1](spark, kept[4], str(tmp_path)).collect()
    assert all(r["m"] == {"k": 1} and r["x.y"] == 3 and (r["piece_ids"] == []) == (not r["text"]) for r in out)


def test_queries_and_pipeline_of_empty_tables(spark, tmp_path):
    odd_tables(spark, str(tmp_path), [], [])
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in Q.QUERIES.items():
        assert query(spark, str(tmp_path)).count() == 0, name


def test_clean_up(spark):
    storage.shared_folder(spark)
    old, spark._tempora_run = spark._tempora_run, spark._tempora_run + "-clean"  # not that of other tests
    try:
        folder = spark._tempora_run.removeprefix("file://")
        one = storage.settled(spark, lambda: storage.stash(spark.range(5)).where("id > 1"))
        assert one.count() == 3 and len(os.listdir(folder)) == 1
        storage.clean(spark)
        assert not os.path.exists(folder)
    finally:
        spark._tempora_run = old
