"""WARC archives: written one gzip member a record, read sequentially.

Writing: each partition writes its records, in page_id order, to archives of its own in
a folder that all executors share; a file gets its name only when it is complete,
and a task that runs again writes the same bytes under the same name.

Reading: each archive is opened as a stream in a task; its bytes are fetched and
inflated piece by piece, record by record, so a task holds one record of an archive of any size. Headers
frame the block by Content-Length, and block and payload digests are verified.

Equal payloads of at least ``min_revisit_bytes`` are written once, as the response
of the largest page_id; the other pages get revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm.common import stored
from visitflow.session import scratch_path

MIN_REVISIT_BYTES = 1000
#: An archive is closed at this many compressed bytes.
ARCHIVE_BYTES = 16 << 20
GZIP_LEVEL = 6
#: Time of all records; archives of the same pages have the same bytes.
RECORD_DATE = "2024-01-01T00:00:00Z"
ID_PREFIX = "urn:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PIECE = 1 << 16


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def _hex(digest: str) -> str:
    return base64.b32decode(digest.removeprefix("sha1:")).hex()


def _header_value(value: str) -> str:
    """A value on one line: control characters become their percent codes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record, uncompressed: a response, or a revisit of the page ``refers_to``."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"),
        ("WARC-Date", RECORD_DATE),
        *([("WARC-Target-URI", _header_value(url))] if url is not None else []),
        *([("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)] if revisit else []),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = GZIP_LEVEL) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ------------------------------------------------------------------ reading


def members(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a stream of bytes; one member is held at a time."""
    inflate, out, begun = zlib.decompressobj(31), [], False
    for piece in pieces:
        while piece:
            begun = True
            out.append(inflate.decompress(piece))
            piece = b""
            if inflate.eof:
                piece = inflate.unused_data
                yield b"".join(out)
                inflate, out, begun = zlib.decompressobj(31), [], False
    if begun:
        raise ValueError("the archive ends inside a gzip member")


def parse(member: bytes) -> dict:
    """Fields and payload of one record; raises ValueError on bad framing or digests."""
    head, gap, rest = member.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not gap or not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"not a header field: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("the block's length differs from Content-Length")
    if _digest(block) != fields["warc-block-digest"]:
        raise ValueError("block digest mismatch")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("no HTTP header")
    sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != int(sizes[0]):
            raise ValueError("the payload's length differs from the HTTP Content-Length")
        if _digest(payload) != fields["warc-payload-digest"]:
            raise ValueError("payload digest mismatch")
    elif payload:
        raise ValueError("a revisit carries a payload")
    return {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "url": fields.get("warc-target-uri"),
        "payload_bytes": int(sizes[0]),
        "payload_digest": _hex(fields["warc-payload-digest"]),
        "refers_to": fields.get("warc-refers-to"),
        "payload": payload if kind == "response" else None,
    }


def _pieces(stream) -> Iterator[bytes]:
    while piece := stream.read(_PIECE):
        yield piece


def archive_names(folder: str) -> list[str]:
    """Paths of the archives in ``folder``, by name."""
    fs, root = pafs.FileSystem.from_uri(folder)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".warc.gz"))


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in ``folder`` (a URI that ``pyarrow.fs`` opens): record_id,
    record_type, url, payload_bytes, payload_digest (hex SHA-1 of the full payload), refers_to
    and, if asked for, payload (null for revisits). A damaged record raises an error.

    Only names pass the driver, one an archive. An archive of any size is read as a stream; a record is
    held whole. No archives: an empty result.
    """
    names = ["record_id", "record_type", "url", "payload_bytes", "payload_digest", "refers_to"]
    names += ["payload"] * payloads

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"]:
                found, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for member in members(_pieces(stream)):
                        row = parse(member)
                        found.append([row[n] for n in names])
                        size += len(member) if payloads else 0
                        if len(found) == 200 or size > ARCHIVE_BYTES:
                            yield pd.DataFrame(found, columns=names)
                            found, size = [], 0
                if found:
                    yield pd.DataFrame(found, columns=names)

    schema = "record_id string, record_type string, url string, payload_bytes long, payload_digest string, refers_to string"
    paths = archive_names(folder)
    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return files.mapInPandas(read, schema + ", payload binary" * payloads)


# ------------------------------------------------------------------ writing


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, hash, refers_to) of the pages whose payload a larger page_id also has."""
    narrow = pages.select("page_id", F.sha2("payload", 256).alias("hash"), F.length("payload").alias("n"))
    long = narrow.where((F.col("n") >= min_bytes) & F.col("page_id").isNotNull()).drop("n")
    groups = long.groupBy("hash").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return long.join(groups.drop("n"), "hash").where("page_id < refers_to").distinct()


def write_archives(
    pages: DataFrame,
    folder: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = GZIP_LEVEL,
) -> DataFrame:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``folder``.

    ``folder`` is a URI that ``pyarrow.fs`` opens on the executors. Returns one row an
    archive: name, records, bytes.

    A null html is an empty payload. A null url leaves out the target. Rows with a
    null page_id are always responses. Rows that repeat the largest page_id of a group of
    equal payloads are all responses. A very long html is one record, whole. Other columns are not read. An empty table
    writes no archive.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    again = revisits(rows, min_revisit_bytes)
    rows = rows.withColumn("hash", F.sha2("payload", 256)).join(again, ["page_id", "hash"], "left")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        done, out, temp, records, size = [], None, "", 0, 0

        def close() -> None:
            nonlocal out
            out.close()
            out = None
            name = f"pages-{part:06d}-{len(done):04d}.warc.gz"
            try:
                fs.move(temp, f"{root}/{name}")
            except OSError:
                # Some stores don't replace: an earlier run of this task left the same bytes.
                if fs.get_file_info(f"{root}/{name}").type != pafs.FileType.File:
                    raise
                fs.delete_file(temp)
            done.append((name, records, size))

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    temp = f"{root}/_{uuid.uuid4().hex}.tmp"
                    out, records, size = fs.open_output_stream(temp), 0, 0
                to = None if pd.isna(row.refers_to) else int(row.refers_to)
                own = None if pd.isna(row.page_id) else int(row.page_id)
                packed = gzip_member(record(own, row.url, bytes(row.payload), to), level)
                out.write(packed)
                records, size = records + 1, size + len(packed)
                if size >= archive_bytes:
                    close()
        if out is not None:
            close()
        yield pd.DataFrame(done, columns=["name", "records", "bytes"])

    ordered = rows.sortWithinPartitions("page_id", "hash", "url").select("page_id", "url", "payload", "refers_to")
    return ordered.mapInPandas(write, "name string, records long, bytes long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to new archives in the shared folder and read their records back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to. Nulls, repeated
    rows and long pages: see ``write_archives``. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    manifest = stored(write_archives(pages, folder), "warc-manifest")
    if not manifest.head(1):
        return spark.createDataFrame(
            [], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
        )
    page = lambda c: F.nullif(F.regexp_extract(c, f"<{ID_PREFIX}(-?[0-9]*)>", 1), F.lit("")).cast("long")
    return read_archives(spark, folder, payloads=False).select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )
