from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from retailgold.llm import warc


def frame(spark, rows):
    return spark.createDataFrame([(k, u, h, "x", "y") for k, u, h in rows], "page_id bigint, url string, html string, digest string, key string").repartition(3)


def want(rows):
    out, last = [], {}
    for k, _, h in rows:
        d = base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
        last.setdefault(d, []).append(k)
        out.append((k, len((h or "").encode()), d))
    best = {d: max((k for k in ks if k is not None), default=None) for d, ks in last.items()}
    return sorted(((k, n, d, "response" if k == best[d] else "revisit", None if k == best[d] else best[d]) for k, n, d in out), key=str)


def test_round_trip(spark, table):
    rows = [(r["page_id"], r["url"], r["html"]) for r in table("pages").collect()]
    rows += [(9_000 + i, "http://copy.example/", rows[i % 5][2]) for i in range(40)]
    got = warc.round_trip(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want(rows)
    assert sum(r["record_type"] == "revisit" for r in got) >= 40


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "http://a\r\n b", "é\r\n\r\nWARC/1.1\r\n\r\n"), (4, "u", "x" * 3_000_000), (5, "u", "same"), (5, "u", "same"), (None, "u", "same"), (None, "u", "alone")]
    got = sorted((tuple(r) for r in warc.round_trip(frame(spark, rows)).collect()), key=str)
    assert got == want(rows)
    assert warc.round_trip(frame(spark, rows).where("false")).count() == 0


def test_small_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    kind = {r["page_id"]: r["record_type"] for r in warc.round_trip(frame(spark, rows), least=3).collect()}
    assert kind == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archives_on_disk(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "text " * i) for i in range(50)]
    raw, norm = f"file://{tmp_path}/raw", f"file://{tmp_path}/norm"
    files = warc.write_monolithic(warc.deduplicated(frame(spark, rows)).coalesce(1), raw).collect()
    assert [r["records"] for r in files] == [50]
    index = warc.normalise(spark.createDataFrame(files), raw, norm).collect()
    (name,) = {r["file"] for r in index}
    whole = (tmp_path / "raw" / name).read_bytes()
    one = zlib.decompressobj(31)
    text = one.decompress(whole)
    assert not one.unused_data  # a single stream
    again = (tmp_path / "norm" / name).read_bytes()
    assert gzip.decompress(again) == text
    for r in index:
        member = zlib.decompressobj(31)
        record = member.decompress(again[r["offset"] : r["offset"] + r["size"]])
        assert member.eof and not member.unused_data and record.startswith(b"WARC/1.1") and record.endswith(b"\r\n\r\n")
    lines = (tmp_path / "norm" / f"{name}.idx").read_text().splitlines()
    assert lines == [f"{r['offset']} {r['size']} {r['id']}" for r in index]


def test_truncated_archive_is_an_error(spark, tmp_path):
    record = warc.record(1, "u", b"abc", warc.sha1_base32(b"abc"), None)
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(record[:-6]))
    with pytest.raises(Exception, match="inside a record"):
        warc.normalise(spark.createDataFrame([("cut.warc.gz",)], "file string"), f"file://{tmp_path}", f"file://{tmp_path}/n").collect()


def test_reader_takes_any_pieces():
    records = [warc.record(i, "u", bytes([65 + i]) * i, "X", None if i % 2 else 5) for i in range(5)]
    for size in (1, 7, 10_000):
        reader, flat = warc.Reader(), b"".join(records)
        got = [r for at in range(0, len(flat), size) for r in reader.feed(flat[at : at + size])]
        assert got == records and not reader.held


def test_sql_digest_is_base32(spark):
    row = spark.range(1).select(warc.digest(F.lit("hello").cast("binary")).alias("d")).first()
    assert row["d"] == warc.sha1_base32(b"hello")


def test_an_archive_is_a_task(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "text") for i in range(60)]
    raw = f"{tmp_path}/raw"
    files = warc.write_monolithic(warc.deduplicated(frame(spark, rows)).repartition(30), raw).collect()
    index = warc.normalise(spark.createDataFrame(files), raw, f"{tmp_path}/norm")
    assert index.rdd.getNumPartitions() == len(files) > 20
    assert index.select("file").distinct().count() == len(files)


def test_folders_on_any_file_system(spark, monkeypatch):
    assert warc.shared_folder(spark, "/a/b") == "file:/a/b" and warc.shared_folder(spark, "file:///a/b") == "file:/a/b"
    assert warc._open_folder("file:/a/b")[1] == warc._open_folder("/a/b")[1] == "/a/b"
    asked = []
    monkeypatch.setattr(warc.pyarrow.fs, "HadoopFileSystem", lambda host: asked.append(host) or host)
    assert warc._open_folder("wasbs://box@host/a/b") == ("wasbs://box@host", "/a/b")
    assert warc._open_folder("dbfs:/a") == ("dbfs://", "/a") and len(asked) == 2

    class Known:
        @staticmethod
        def from_uri(uri):
            return uri, "x"

    monkeypatch.setattr(warc.pyarrow.fs, "FileSystem", Known)
    assert warc._open_folder("s3a://bucket/a")[0] == "s3://bucket/a"
