import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from tablelens.llm import warc


def pages(spark, tmp_path, rows, name="p"):
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    df.repartition(3).write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


ROWS = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, "http://a/9", "same"), (3, None, None), (4, "http://a/\r\nx", ""), (5, "http://é/", "<p>é" * 9000), (6, "u", "only")]


def test_round_trip(spark, tmp_path):
    got = sorted((tuple(r) for r in warc.round_trip(pages(spark, tmp_path, ROWS)).collect()), key=str)
    best = {}
    for i, _, t in ROWS:
        best[t or ""] = max(i, best.get(t or "", 0))
    exp = [(i, len((t or "").encode()), digest(t), "response" if best[t or ""] == i else "revisit", None if best[t or ""] == i else best[t or ""]) for i, _, t in ROWS]
    assert got == sorted(exp, key=str)


def test_null_and_repeated_ids_threshold_and_empty(spark, tmp_path):
    df = pages(spark, tmp_path, [(7, "a", "x"), (7, "a", "x"), (None, "b", "x"), (None, None, "alone"), (1, "c", "long text"), (2, "c", "long text")])
    rows = warc.round_trip(df).collect()
    assert len(rows) == 6
    x = sorted((r.page_id is None, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 1)
    assert x == [(False, "response", None), (False, "revisit", 7), (True, "revisit", 7)]
    kinds = [r.record_type for r in warc.round_trip(df, least_bytes=6).collect()]
    assert kinds.count("revisit") == 1
    assert warc.round_trip(df.filter("false")).count() == 0


def test_archives_are_gzip_members_and_payloads_survive(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(pages(spark, tmp_path, ROWS), path)
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "w").glob("*.warc.gz"))
    assert plain.count(b"WARC/1.1\r\n") == len(ROWS)
    back = {r.headers["x-page-id"]: r for r in warc.read(spark, "file:" + path).collect()}
    assert bytes(back["5"].payload).decode() == "<p>é" * 9000 and back["5"].target_uri == "http://é/"
    assert back["4"].target_uri == "http://a/%0D%0Ax" and back["1"].payload is None and back["1"].refers_to == back["9"].record_id


def test_predicates_reach_the_source_and_payloads_are_skipped(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "w")
    warc.write(pages(spark, tmp_path, ROWS), path)
    df = warc.read(spark, path).filter((F.col("warc_type") == "revisit") & F.col("refers_to").isNotNull())
    assert " Filter " not in df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
    assert sorted(int(r.headers["x-page-id"]) for r in df.collect()) == [1, 2, 3]
    heads = warc.read(spark, path, types="response", payload=False).collect()
    assert len(heads) == 4 and all(r.payload is None for r in heads) and {r.http_content_length for r in heads} == {4, 0, 45000}
    monkeypatch.setattr(warc, "SPLIT", 150)  # ranges that begin inside members
    reader = warc._Reader({"path": path})
    parts = reader.partitions()
    rows = [x for p in parts for b in reader.read(p) for x in b.to_pylist()]
    assert len(parts) > 5 and sorted(r["record_id"] for r in rows) == sorted(r.record_id for r in warc.read(spark, path).collect())


def test_foreign_archives(spark, tmp_path):
    body = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:1>\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:2>\r\nX-Long: a\r\n b\r\nContent-Type: application/http\r\nContent-Length: 43\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\nworld\r\n\r\n"
    for name, data in (("a.warc", body + two), ("b.warc.gz", gzip.compress(body) + gzip.compress(two)), ("c.warc.gz", b"")):
        (tmp_path / name).write_bytes(data)
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sorted((r.warc_type, bytes(r.payload)) for r in rows) == [("response", b"world")] * 2 + [("warcinfo", b"hello")] * 2
    assert {r.headers.get("x-long") for r in rows} == {None, "a b"}
    assert warc.read(spark, str(tmp_path / "b.warc.gz"), types="warcinfo").count() == 1
