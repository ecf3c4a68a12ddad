"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames; a skippable frame with the seek table ends each bundle, and an index maps
record identifiers to bundle, frame and offset in the frame. Equal payloads of at least `revisit_from` bytes are stored
once: the record of the largest page_id is the response, the others are revisits that name it.

Defined cases: a null html is an empty payload; rows that repeat a page_id are records of their own (of several with the
largest page_id one is the response); a null page_id is smaller than any other; an empty table gives no bundle.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_limits, materialise, scratch_path

# Fixed values of the seekable format: magic numbers, descriptor with checksums.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
#: Uncompressed bytes of a frame, bytes of a bundle after which the next begins, payload bytes from which copies are revisits.
FRAME, BUNDLE, REVISIT_FROM = 1 << 20, 1 << 30, 1000

INDEX = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("bundle", T.StringType()), T.StructField("frame", T.IntegerType()), T.StructField("frame_start", T.LongType()), T.StructField("frame_bytes", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("record_bytes", T.LongType())])
FRAMES = "bundle string, frame int, frame_start long, frame_bytes int, size int, checksum long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string, payload binary"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str, nth: int) -> str:
    """The identifier of the nth row with a page_id and payload."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id}:{digest}:{nth}'.encode()).digest()[:16], version=4)}>"


def _line(value: str) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url, body: bytes, nth: int, copied: bool, owner_page) -> tuple[str, bytes]:
    """A record's identifier and bytes; a revisit if the payload is copied and this isn't its first row with the owner's page_id."""
    digest = hashlib.sha1(body).hexdigest()
    rid = record_id(page_id, digest, nth)
    revisit = copied and (page_id != owner_page or nth > 0)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {rid}", "WARC-Date: 1970-01-01T00:00:00Z"]
    head += ([f"WARC-Target-URI: {_line(url)}"] if url is not None else []) + [f"X-Page-Id: {page_id}"] * (page_id is not None)
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(body)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(owner_page, digest, 0)}"]
        head += [f"X-Refers-To-Page: {owner_page}"] * (owner_page is not None)
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields (lower case), block and end of the record that begins at an offset."""
    mid = data.index(b"\r\n\r\n", at)
    lines = data[at:mid].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    end = mid + 4 + int(head["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end as its length says")
    return head, data[mid + 4 : end], end + 4


class BundleWriter:
    """Writes one bundle: frames as they fill, the seek table when closed. The file gets its name only then."""

    def __init__(self, uri: str):
        import zstandard

        self.uri, (self.fs, self.path) = uri, _fs(uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.path + ".part")
        self.zstd, self.frames, self.start = zstandard.ZstdCompressor(level=3), [], 0
        self.buffer, self.waiting = bytearray(), []

    def add(self, rid: str, page_id, data: bytes) -> list[tuple]:
        out = self.flush() if self.buffer and len(self.buffer) + len(data) > FRAME else []
        self.waiting.append((rid, page_id, len(self.buffer), len(data)))
        self.buffer += data
        return out

    def flush(self) -> list[tuple]:
        """Write the frame; index rows of its records."""
        import xxhash

        if not self.buffer:
            return []
        raw = bytes(self.buffer)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        rows = [(rid, page, self.uri, len(self.frames), self.start, len(packed), at, n) for rid, page, at, n in self.waiting]
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.start += len(packed)
        self.buffer, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)
        return rows


def seek_table(uri: str) -> list[tuple[int, int, int, int]]:
    """(start, bytes, uncompressed bytes, checksum) of each frame, from the footer of a bundle."""
    fs, path = _fs(uri)
    with fs.open_input_file(path) as f:
        size = f.size()
        f.seek(size - 9)
        n, kind, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE or kind != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table")
        f.seek(size - 9 - 12 * n)
        entries = struct.unpack(f"<{3 * n}I", f.read(12 * n))
    out, at = [], 0
    for i in range(n):
        packed, raw, check = entries[3 * i : 3 * i + 3]
        out.append((at, packed, raw, check))
        at += packed
    return out


def read_frame(f, start: int, packed: int, raw: int, check: int | None = None) -> bytes:
    import xxhash
    import zstandard

    f.seek(start)
    data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=raw)
    if check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("a frame's checksum is wrong")
    return data


def fetch(entry) -> tuple[dict[str, str], bytes]:
    """The record of an index row, by reading its frame alone."""
    fs, path = _fs(entry["bundle"])
    _, _, raw, check = seek_table(entry["bundle"])[entry["frame"]]
    with fs.open_input_file(path) as f:
        return parse(read_frame(f, entry["frame_start"], entry["frame_bytes"], raw, check), entry["offset"])[:2]


def write_archives(pages: DataFrame, out: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Write pages (page_id, url, html) to bundles under a folder that all executors share; the index, read back from its table there."""
    spark = pages.sparkSession
    arrow_limits(spark)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    # small payloads get keys of their own, so no key is empty or common for want of a payload
    key = F.when(F.octet_length("body") >= revisit_from, F.sha2("body", 256)).otherwise(F.concat_ws(":", F.coalesce(F.col("page_id"), F.lit(0)), F.xxhash64("page_id", "url", "body")))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), body.alias("body")).withColumn("key", key).withColumn("large", F.octet_length("body") >= revisit_from)
    counted = materialise(rows.groupBy("key", "large", "page_id").agg(F.count("*").alias("n")).filter("large or n > 1"), "warc-counts")
    top = counted.filter("large").groupBy("key").agg(F.max(F.struct("page_id", "n")).alias("top"), F.sum("n").alias("rows")).filter("rows > 1")
    owners = materialise(top.select("key", F.col("top.page_id").alias("owner_page"), F.lit(True).alias("copied")), "warc-owners")
    planned = rows.join(owners, "key", "left")
    again = counted.filter("n > 1").select(F.col("key").alias("again"), F.col("page_id").alias("again_page"))
    if again.head(1):
        # rows that repeat page_id and payload are numbered: the first may be the response, all get identifiers of their own
        same = (F.col("key") == F.col("again")) & F.col("page_id").eqNullSafe(F.col("again_page"))
        number = F.row_number().over(Window.partitionBy("key", "page_id").orderBy("url")) - 1
        once = planned.join(again, same, "left_anti").withColumn("nth", F.lit(0))
        planned = once.unionByName(planned.join(again, same, "left_semi").withColumn("nth", number))
    else:
        planned = planned.withColumn("nth", F.lit(0))
    plan = planned.select("page_id", "url", "body", "nth", F.coalesce("copied", F.lit(False)).alias("copied"), "owner_page")

    def write(batches):
        names, writer = [f.name for f in INDEX.fields], None
        as_batch = lambda rows: pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)
        arrow = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("frame_bytes", pa.int32()), ("offset", pa.int64()), ("record_bytes", pa.int64())])
        for batch in batches:
            done = []
            for x in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "body", "nth", "copied", "owner_page")), strict=True):
                if writer is None:
                    writer = BundleWriter(f"{out}/bundles/{uuid.uuid4().hex}.warc.zst")
                rid, data = record(*x)
                done += writer.add(rid, x[0], data)
                if writer.start > BUNDLE:
                    done += writer.close()
                    writer = None
            if done:
                yield as_batch(done)
        if writer is not None:
            yield as_batch(writer.close())

    plan.mapInArrow(write, INDEX).write.mode("overwrite").parquet(f"{out}/index")
    return spark.read.schema(INDEX).parquet(f"{out}/index")


def read_archives(spark: SparkSession, index: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the bundles named in an index, parsed from their frames; the frames are dealt out evenly."""
    arrow_limits(spark)

    def tables(batches):
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                got = seek_table(uri)
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(got)), pa.array(range(len(got)), pa.int32()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32()), pa.array([g[3] for g in got], pa.int64())], names=["bundle", "frame", "frame_start", "frame_bytes", "size", "checksum"])

    def records(batches):
        for batch in batches:
            for f in batch.to_pylist():
                fs, path = _fs(f["bundle"])
                with fs.open_input_file(path) as h:
                    data = read_frame(h, f["frame_start"], f["frame_bytes"], f["size"], f["checksum"])
                at, out = 0, []
                while at < len(data):
                    head, block, at = parse(data, at)
                    kind, digest, n = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
                    if kind == "response" and (len(block), hashlib.sha1(block).hexdigest()) != (n, digest):
                        raise ValueError(f"the payload of {head['warc-record-id']} is damaged")
                    out.append({"page_id": int(head["x-page-id"]) if "x-page-id" in head else None, "payload_bytes": n, "payload_digest": digest, "record_type": kind, "refers_to": int(head["x-refers-to-page"]) if "x-refers-to-page" in head else None, "record_id": head["warc-record-id"], "url": head.get("warc-target-uri"), "payload": block if payloads else None})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("payload", pa.binary())]))

    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    frames = index.select("bundle").distinct().mapInArrow(tables, FRAMES).repartition(n)
    return frames.mapInArrow(records, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write an archive of pages in the shared folder and read it back: one row per page."""
    out = scratch_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(pages, out)).drop("payload")
