"""WARC: round trip, revisits, pushdown, and archives of other makers."""

import gzip
import hashlib
import os
import zlib

import pytest
from pyspark.sql import functions as F

from tempora.llm import warc as W

LONG = "<html>" + "long page é " * 40
SCHEMA = "page_id long, url string, html string"
ROWS = [(5, "http://a/5", LONG), (2, "http://a/2", LONG), (9, "http://a/9", LONG), (1, "http://a/1", "short"), (3, "http://a/3", "short"), (4, None, None), (6, "http://a/6", ""), (7, "http://a/7\r\nX: y", "WARC/1.1\r\n\r\n" * 30), (None, "http://a/n", LONG)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('warc')}"
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumn("headers", F.lit("clash"))
    manifest = W.write_archives(pages, path)
    assert manifest.agg(F.sum("records")).first()[0] == len(ROWS)
    return path


def test_round_trip_and_revisits(spark, folder):
    rows = {r["page_id"]: r for r in W.read_archives(spark, folder).collect()}
    assert len(rows) == len(ROWS)
    for key, _, html in ROWS:
        raw = (html or "").encode()
        r = rows[key]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest())
        again = html == LONG and key != 2
        assert (r["warc_type"], r["refers_to"]) == (("revisit", 2) if again else ("response", None)), key
        assert bytes(r["payload"] or b"") == (b"" if again else raw)
    assert rows[5]["headers"]["WARC-Refers-To"] == rows[2]["record_id"]


def test_predicates_are_pushed_down_and_payloads_skipped(spark, folder):
    df = W.read_archives(spark, folder, payload=False, pushdown=True).where((F.col("warc_type") == "revisit") & (F.col("payload_bytes") > 10))
    plan = df._jdf.queryExecution().executedPlan().toString()
    tested = plan.split("Filter", 1)[1].splitlines()[0]  # Spark tests what the source did not take
    assert "payload_bytes" in tested and "warc_type" not in tested, plan
    assert sorted(r["page_id"] or 0 for r in df.collect()) == [0, 5, 9]
    reader = W.PushdownReader({"path": folder})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    assert list(reader.pushFilters([EqualTo(("page_id",), 2), GreaterThan(("payload_bytes",), 1)])) == [GreaterThan(("payload_bytes",), 1)]
    inflated = []
    row = W.WarcReader._row
    reader._row = lambda headers, block: inflated.append(headers["X-Page-Id"]) or row(reader, headers, block)
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 1 and inflated == ["2"]


def test_partitions_follow_the_bytes(folder):
    reader = W.WarcReader({"path": folder, "partbytes": "1"})
    files = [f for _, _, fs in os.walk(folder.removeprefix("file://")) for f in fs if f.endswith(".warc.gz")]
    assert len(reader.partitions()) == len(files)


def test_archives_without_lengths_and_without_compression(spark, tmp_path):
    records = [W.record("response", k, "http://b", f"page {k}".encode(), hashlib.sha256(f"page {k}".encode()).hexdigest(), None, "2020-01-01T00:00:00Z") for k in range(3)]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "two.warc").write_bytes(b"".join(records))
    (tmp_path / "three.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    rows = W.read_archives(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["payload"]).decode() for r in rows) == sorted([f"page {k}" for k in range(3)] * 3)


def test_members_are_plain_gzip():
    raw = os.urandom(5000)
    assert gzip.decompress(W.member(raw)) == raw and zlib.decompress(W.member(raw), 31) == raw


def test_damage_is_told(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(W.record("response", 1, "u", b"payload", "0" * 64, None, "d"))
    with pytest.raises(Exception, match="does not have the digest"):
        W.read_archives(spark, str(tmp_path)).collect()


def test_ties_repeats_and_empty_tables(spark, tmp_path):
    rows = [(1, "u", LONG), (1, "u", LONG), (2, "u", LONG)]
    W.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "t"))
    assert sorted((r["page_id"], r["warc_type"]) for r in W.read_archives(spark, str(tmp_path / "t")).collect()) == [(1, "response"), (1, "response"), (2, "revisit")]
    assert W.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "e")).count() == 0
    assert W.read_archives(spark, str(tmp_path / "e")).count() == 0


def damaged(folder):
    """An archive of ten records with LX fields; all payloads but the fourth's are spoilt behind the headers."""
    parts = []
    for k in range(10):
        payload = os.urandom(20_000)
        part = bytearray(W.member(W.record("response", k, f"http://h/{k % 2}/{k}", payload, hashlib.sha256(payload).hexdigest(), None, "d")))
        if k != 4:
            part[-5000:] = bytes(5000)
        parts.append(bytes(part))
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/x.warc.gz", "wb") as f:
        f.write(b"".join(parts))


@pytest.mark.parametrize("wanted", ["page_id = 4", "page_id IN (4, 77)", "target_uri LIKE 'http://h/0/4%'", "page_id > 3 AND page_id < 5", "target_uri LIKE '%/4'"])
def test_payloads_of_records_that_fail_are_never_inflated(spark, tmp_path, wanted):
    damaged(str(tmp_path))
    df = W.read_archives(spark, str(tmp_path), pushdown=True).where(wanted)
    assert [(r["page_id"], r["payload_bytes"]) for r in df.collect()] == [(4, 20_000)]
    df = W.read_archives(spark, str(tmp_path))
    assert W.read_archives(spark, str(tmp_path), payload=False).count() == 10
    with pytest.raises(Exception, match="Error -3|cut short|digest"):
        df.where(wanted).collect()


def test_one_table_under_several_predicates(spark, folder):
    every = W.read_archives(spark, folder)
    assert [every.where(f"page_id = {k}").count() for k in (5, 2)] == [1, 1] and every.count() == len(ROWS)
    both = every.where("page_id = 5").select("page_id").unionByName(every.where("page_id = 2").select("page_id"))
    assert sorted(r["page_id"] for r in both.collect()) == [2, 5]
    some = W.read_archives(spark, folder, where=[("EqualTo", "warc_type", "revisit"), ("In", "page_id", [5, 2, 9])])
    assert sorted(r["page_id"] for r in some.collect()) == [5, 9] and some.where("page_id = 9").count() == 1 and some.count() == 2
    with pytest.raises(ValueError, match="do not tell"):
        W.read_archives(spark, folder, where=[("EqualTo", "payload_bytes", 3)])


def test_skipped_bytes_are_not_inflated_and_memory_is_bounded(tmp_path):
    import tracemalloc

    body = os.urandom(1 << 20) * 24
    record = W.record("response", 1, "u", body, hashlib.sha256(body).hexdigest(), None, "d")
    tail = W.record("response", 2, "u", b"end", hashlib.sha256(b"end").hexdigest(), None, "d")
    for name, raw, most in (("lx", W.member(record) + W.member(tail), 1 << 18), ("gz", gzip.compress(record, 1) + gzip.compress(tail), 1 << 26), ("one", gzip.compress(record + tail, 1), 1 << 26), ("plain", record + tail, 0)):
        (tmp_path / name).write_bytes(raw)
        del raw
        tracemalloc.start()
        with open(tmp_path / name, "rb") as f:
            archive = W.Archive(f)
            assert [h["X-Page-Id"] for h, _ in archive] == ["1", "2"]
        assert archive.inflated <= most and tracemalloc.get_traced_memory()[1] < 2 << 20, name
        tracemalloc.stop()
        with open(tmp_path / name, "rb") as f:
            assert [hashlib.sha256(b"".join(W._payload(h, b))).hexdigest() for h, b in W.Archive(f)] == [hashlib.sha256(x).hexdigest() for x in (body, b"end")]


def test_digests_of_other_kinds(spark, tmp_path):
    import base64

    def foreign(k, payload, digest):
        head = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r{k}>\r\nWARC-Payload-Digest: {digest}\r\nX-Page-Id: no number\r\nContent-Length: {len(payload)}\r\n\r\n"
        return gzip.compress(head.encode() + payload + b"\r\n\r\n")

    one = "sha1:" + base64.b32encode(hashlib.sha1(b"one").digest()).decode()
    (tmp_path / "a.warc.gz").write_bytes(foreign(1, b"one", one) + foreign(2, b"two", "md5:x") + foreign(3, b"three", ""))
    rows = {r["record_id"]: r for r in W.read_archives(spark, str(tmp_path)).collect()}
    assert [bytes(rows[f"<r{k}>"]["payload"]) for k in (1, 2, 3)] == [b"one", b"two", b"three"] and rows["<r1>"]["page_id"] is None
    digest = hashlib.sha256(b"one").hexdigest()
    assert [r["record_id"] for r in W.read_archives(spark, str(tmp_path)).where(F.col("payload_digest") == digest).collect()] == ["<r1>"]
    digested = W.read_archives(spark, str(tmp_path), payload="digest").where("record_id = '<r1>'").first()
    assert (digested["payload"], digested["payload_bytes"], digested["payload_digest"]) == (None, 3, digest)
    (tmp_path / "a.warc.gz").write_bytes(foreign(1, b"other", one))
    with pytest.raises(Exception, match="does not have the digest"):
        W.read_archives(spark, str(tmp_path)).collect()
    assert W.read_archives(spark, str(tmp_path), verify=False).count() == 1
    (tmp_path / "a.warc.gz").write_bytes(foreign(1, b"other", "")[:-20])
    with pytest.raises(Exception, match="cut short"):
        W.read_archives(spark, str(tmp_path)).collect()


def test_a_payload_larger_than_a_batch(spark, tmp_path):
    rows = [(1, "u", "x" * (9 << 20)), (2, "u", "y")]
    W.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert {r["page_id"]: len(r["payload"]) for r in W.read_archives(spark, str(tmp_path)).collect()} == {1: 9 << 20, 2: 1}
