"""WARC: exact round trips, framing and digests."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from visitflow.llm import warc
from visitflow.session import scratch_path

PAGES = "page_id long, url string, html string, record_type string, hash string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


def test_round_trip_with_odd_rows(spark):
    long = "ä<p>" * 400
    rows = [(1, "http://a/", long), (2, None, long), (9, "http://b/\r\nX: y", long), (3, "http://c/", None)]
    rows += [(4, "", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", long), (9, "http://b/", long)]
    rows += [(7, "u", "\r\n\r\n" * 300), (8, "u", "x" * 999), (10, "u", "x" * 999)]
    got = sorted(map(tuple, warc.round_trip(pages(spark, rows)).collect()), key=str)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        again = body == long.encode() and i is not None and i < 9
        want.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 9 if again else None))
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_files_are_plain_warc(spark, tmp_path):
    folder = scratch_path(spark, "warc-test")
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * 200) for i in range(50)]
    manifest = warc.write_archives(pages(spark, rows).repartition(3), folder, archive_bytes=4000).collect()
    assert sum(r["records"] for r in manifest) == 50 and len(manifest) > 3
    back = warc.read_archives(spark, folder)
    assert {bytes(r["payload"]).decode() for r in back.collect()} == {h for _, _, h in rows}
    assert {r["url"] for r in back.collect()} == {u for _, u, _ in rows}


def test_members_are_read_piece_by_piece():
    records = [warc.record(i, "u", b"x" * i, None) for i in (0, 1, 5000)]
    data = b"".join(map(warc.gzip_member, records))
    assert gzip.decompress(data) == b"".join(records)
    for step in (1, 7, len(data)):
        pieces = (data[i : i + step] for i in range(0, len(data), step))
        assert list(warc.members(pieces)) == records


def test_damage_is_noticed():
    whole = warc.record(1, "u", b"payload", None)
    assert warc.parse(whole)["payload"] == b"payload"
    for bad in (whole.replace(b"payload", b"paYload"), whole[:-3], whole + b"x", b"junk", whole.replace(b"Length: 7", b"Length: 6")):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        list(warc.members([warc.gzip_member(whole)[:-5]]))


def test_archives_are_read_as_streams(spark):
    """One archive of many pieces, and one cut inside a member: an error, not fewer records."""
    import pyarrow.fs as pafs

    folder = scratch_path(spark, "warc-stream")
    rng = __import__("random").Random(5)
    rows = [(i, "u", "".join(rng.choices("abcdefgh ", k=30_000))) for i in range(60)]
    manifest = warc.write_archives(pages(spark, rows).coalesce(1), folder).collect()
    assert len(manifest) == 1 and manifest[0]["bytes"] > 8 * warc._PIECE
    assert {bytes(r["payload"]).decode() for r in warc.read_archives(spark, folder).collect()} == {h for _, _, h in rows}
    (path,) = warc.archive_names(folder)
    fs, _ = pafs.FileSystem.from_uri(folder)
    with fs.open_input_stream(path, compression=None) as stream:
        data = stream.read()
    with fs.open_output_stream(path, compression=None) as out:
        out.write(data[: len(data) - 1000])
    with pytest.raises(Exception, match="inside a gzip member"):
        warc.read_archives(spark, folder).collect()
    assert warc.read_archives(spark, scratch_path(spark, "warc-none")).count() == 0
