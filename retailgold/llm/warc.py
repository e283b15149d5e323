"""WARC archives, and their normaliser: one gzip stream per file in, one gzip member per record and an index out.

``write_monolithic`` writes a record per row into archives that are a single gzip stream each.  ``normalise`` inflates
each such file once from front to back, in pieces, writes every record as a member of its own and puts an index of the
offsets beside the file.  ``read_records`` goes by the index: it seeks to a record and inflates its member alone.

Archives lie below the shared folder.  A task writes under a name of its own attempt and renames the finished file, so a
repeated task replaces its own file and a lost one leaves nothing that is read.

Of records with equal payloads of at least ``least`` bytes that with the largest key is the response and the others
revisit it; rows that repeat the largest key are all responses, rows with a null key revisit like others and are the
response only where no key is known.  A null payload counts as empty.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgold.llm.frames import arrow_schema, pieces, small_batches
from retailgold.session import file_system, scratch_dir

PIECE = 1 << 20
ARCHIVE_BYTES = 64 << 20  # payload after which a task starts its next archive
READ_BYTES = 8 << 20  # compressed bytes that are read together
END = b"\r\n\r\n"


def digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column, from SQL functions."""
    sha = F.sha1(payload)
    # 160 bits are 32 signs of 5 bits: 8 signs for each 10 hex digits
    signs = [
        F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), (F.shiftright(part, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1))
        for k in range(4)
        for part in [F.conv(F.substring(sha, 10 * k + 1, 10), 16, 10).cast("bigint")]
        for i in range(8)
    ]
    return F.concat(*signs)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def deduplicated(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """(key, url, payload, digest, refers_to): refers_to is null for responses.

    Payloads are grouped by their digest: only digests and keys are aggregated, and the join back may split a hot digest.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", digest(F.col("payload")))
    last = rows.where(F.length("payload") >= least).groupBy("digest").agg(F.max("key").alias("last"), F.count("*").alias("n"))
    # only digests that repeat need the join's other side
    last = last.where("n > 1").select("digest", "last")
    return rows.join(last, "digest", "left").select(
        "key", "url", "payload", "digest", F.when(~F.col("last").eqNullSafe(F.col("key")), F.col("last")).alias("refers_to")
    )


def record(key, url: str | None, payload: bytes, sha: str, refers_to) -> bytes:
    """A response record, or a revisit that names the response and the size of the payload it leaves out."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if key is None else key}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{sha}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        payload = b""
    return "\r\n".join([*head, f"Content-Length: {len(payload)}"]).encode() + END + payload + END


def fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


class Reader:
    """Records from a stream that is handed over in pieces; keeps no more than one record and a piece."""

    def __init__(self) -> None:
        self.held, self.need = bytearray(), 0

    def feed(self, data: bytes) -> Iterator[bytes]:
        self.held += data
        while len(self.held) >= self.need:
            end = self.held.find(END)
            if end < 0:
                return
            size = end + len(END) + int(fields(bytes(self.held[:end]))["content-length"]) + len(END)
            if len(self.held) < size:
                self.need = size
                return
            yield bytes(self.held[:size])
            del self.held[:size]
            self.need = 0


# What pyarrow opens itself, by scheme; every other scheme goes through the Hadoop client that the cluster has for it.
_OWN_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: a path without one is in the cluster's default file system, as for Spark itself."""
    fs, path = file_system(spark, folder)
    return path.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString()


def _open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a qualified folder, and the path there."""
    uri = urlsplit(folder)
    if uri.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), uri.path
    if uri.scheme in _OWN_SCHEMES:
        return pyarrow.fs.FileSystem.from_uri(folder.replace(uri.scheme, _OWN_SCHEMES[uri.scheme], 1))
    return pyarrow.fs.HadoopFileSystem(f"{uri.scheme}://{uri.netloc}"), uri.path


def _attempt() -> tuple[int, str]:
    task = TaskContext.get()
    return task.partitionId(), f"{task.stageId()}-{task.taskAttemptId()}"


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """Writes (key, url, payload, digest, refers_to) rows; one row per archive: file, records."""
    small_batches(records.sparkSession)
    folder = shared_folder(records.sparkSession, folder)
    schema = arrow_schema("file string, records bigint")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_folder(folder)
        fs.create_dir(base)
        part, attempt = _attempt()
        out, done = None, []

        def close():
            out.write(pack.flush())
            out.close()
            fs.move(f"{base}/.{attempt}-{len(done)}", f"{base}/{name}")
            done.append((name, count))

        for keys, urls, payloads, shas, refers in pieces(batches, 2):
            for row in zip(keys, urls, payloads, shas, refers):
                if out is None:
                    name, count, size = f"part-{part:06d}-{len(done):04d}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/.{attempt}-{len(done)}", compression=None)
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = record(*row)
                out.write(pack.compress(raw))
                count, size = count + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], schema=schema)

    return records.mapInArrow(write, "file string, records bigint")


def normalise(archives: DataFrame, folder: str, to: str) -> DataFrame:
    """Rewrites each archive named in column ``file``; rows of its index: file, offset, size, id.

    The index also lies beside the archive, as lines of ``offset size id``.  Each archive is a task of its own: their number
    is counted first, because names are too small for the sizes by which partitions are otherwise merged.
    """
    spark = archives.sparkSession
    folder, to = shared_folder(spark, folder), shared_folder(spark, to)
    archives = archives.select("file")
    archives = archives.repartitionByRange(max(1, archives.count()), "file")
    schema_text = "file string, offset bigint, size bigint, id string"
    schema = arrow_schema(schema_text)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_folder(folder)
        target, to_base = _open_folder(to)
        target.create_dir(to_base)
        _, attempt = _attempt()
        for (names,) in pieces(batches, None):
            for name in names:
                rows, at, reader = [], 0, Reader()
                temporary = f"{to_base}/.{attempt}-{name}"
                with target.open_output_stream(temporary, compression=None) as out:
                    for data in inflated(fs, f"{base}/{name}"):
                        for raw in reader.feed(data):
                            member = zlib.compressobj(1, zlib.DEFLATED, 31)
                            packed = member.compress(raw) + member.flush()
                            out.write(packed)
                            rows.append((at, len(packed), fields(raw[: raw.index(END)])["warc-record-id"]))
                            at += len(packed)
                if reader.held:
                    raise ValueError(f"{name} ends inside a record")
                with target.open_output_stream(f"{temporary}.idx", compression=None) as out:
                    out.write("".join(f"{a} {n} {i}\n" for a, n, i in rows).encode())
                target.move(f"{temporary}.idx", f"{to_base}/{name}.idx")
                target.move(temporary, f"{to_base}/{name}")
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
                ], schema=schema)

    return archives.mapInArrow(rewrite, schema_text)


def inflated(fs: pyarrow.fs.FileSystem, path: str) -> Iterator[bytes]:
    """A gzip file in pieces of at most ``PIECE`` bytes; also one of several members."""
    with fs.open_input_stream(path, compression=None) as file:
        unpack = zlib.decompressobj(31)
        while data := file.read(PIECE):
            while data:
                yield unpack.decompress(data, PIECE)
                data = unpack.unconsumed_tail
                if unpack.eof:
                    data = unpack.unused_data
                    unpack = zlib.decompressobj(31)
        yield unpack.flush()


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the indexed records, each read on its own.

    Size and digest of a response are computed from the payload that was read; a mismatch with its header is an error.
    """
    schema_text = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema = arrow_schema(schema_text)
    folder = shared_folder(index.sparkSession, folder)

    def number(urn: str | None):
        text = urn[len("<urn:page:") : -1] if urn else ""
        return int(text) if text else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_folder(folder)
        name, file = None, None
        for files, offsets, sizes in pieces(batches, None):
            out = []
            for path, offset, size in zip(files, offsets, sizes):
                if path != name:
                    if file:
                        file.close()
                    name, file = path, fs.open_input_file(f"{base}/{path}")
                raw = zlib.decompress(file.read_at(size, offset), 31)
                cut = raw.index(END)
                head = fields(raw[:cut])
                payload = raw[cut + len(END) : -len(END)]
                said, length = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                if head["warc-type"] == "response" and (said, length) != (sha1_base32(payload), len(payload)):
                    raise ValueError(f"{path}:{offset} does not hold the payload it names")
                out.append((number(head["warc-record-id"]), length, said, head["warc-type"], number(head.get("warc-refers-to"))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    # A run of neighbouring records is a unit of work, so that one large archive is read by many tasks.  Their number follows from
    # the bytes they stand for, as the index itself is small.
    total = index.agg(F.sum("size").alias("n")).first()["n"] or 0
    tasks = -(-total // READ_BYTES) + index.sparkSession.sparkContext.defaultParallelism
    spread = F.floor(F.col("offset") / READ_BYTES)
    units = index.select("file", "offset", "size").repartition(tasks, "file", spread)
    return units.sortWithinPartitions("file", "offset").mapInArrow(read, schema_text)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Writes all pages, normalises the archives and reads every record back."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    written = write_monolithic(deduplicated(pages, key, url, html, least), f"{folder}/raw")
    written.write.parquet(f"{folder}/written")
    archives = spark.read.parquet(f"{folder}/written")
    normalise(archives, f"{folder}/raw", f"{folder}/records").write.parquet(f"{folder}/index")
    return read_records(spark.read.parquet(f"{folder}/index"), f"{folder}/records")
