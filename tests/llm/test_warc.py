import hashlib
import io
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from mise.llm import warc as W

SCHEMA = "page_id long, url string, html string"
LONG = "<p>one page of text é</p>" * 40
ROWS = [(3, "http://a/3", LONG), (1, "http://a/1", LONG), (9, None, LONG), (None, "http://a/none", LONG), (4, "http://a/4", "short"), (5, "http://a/5", "short"),
        (6, "http://a/6", None), (7, None, ""), (8, "http://a/b c\r\nX: 1", "x" * 99), (10, "u", "x" * 100), (11, "u", "x" * 100), (11, "u", "x" * 100),
        (None, None, "y" * 300), (None, "v", "y" * 300), (12, "http://a/12", "WARC/1.1\r\n\r\n" * 30 + "Content-Length: 5"), (13, "z", "é" * 400_000)]


def brute(rows):
    seen, out = {}, []
    for i, (page, url, html) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][1] is not None, x[1][1] or "", x[0])):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        if len(data) >= W.LEAST_BYTES and digest in seen:
            out.append((page, len(data), digest, "revisit", seen[digest][0]))
        else:
            seen[digest] = (page,)
            out.append((page, len(data), digest, "response", None))
    return sorted(map(str, out))


def archive(spark, rows, folder, **kw):
    pages = spark.createDataFrame(rows, SCHEMA)
    return W.write_bundles(W.archive_records(pages), folder, **kw)


@pytest.mark.parametrize("kw", [{}, {"frame_bytes": 500, "bundle_bytes": 800}])
def test_round_trip(spark, tmp_path, kw):
    folder = f"file://{tmp_path}/a"
    index = archive(spark, ROWS, folder, **kw)
    back = W.read_bundles(W.bundles(index), folder, payloads=True, partitions=3).cache()
    rows = back.collect()
    assert sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in rows) == brute(ROWS)
    assert all(r["intact"] for r in rows) and len({r["record_id"] for r in rows}) == len(ROWS) == index.count()
    by_id = {r["record_id"]: r for r in rows}
    for r in rows:
        if r["record_type"] == "revisit":
            first = by_id[r["refers_to_id"]]
            assert (first["page_id"], first["payload_digest"], first["record_type"]) == (r["refers_to"], r["payload_digest"], "response")
            assert r["payload"] is None
    full = W.resolved(back).collect()
    assert sorted(str((r["page_id"], r["payload"])) for r in full) == sorted(str((p, t or "")) for p, _, t in ROWS)
    urls = {r["page_id"]: r["url"] for r in rows}
    assert urls[8] == "http://a/b%20c%0D%0AX:%201" and urls[7] is None and urls[4] == "http://a/4"
    assert index.select("bundle").distinct().count() > (5 if kw else 0)


def test_bundles_are_plain_warc_files(spark, tmp_path):
    """Any Zstandard decompressor reads them: frames one after the other, the seek table skipped."""
    index = archive(spark, ROWS, f"file://{tmp_path}/a", frame_bytes=500)
    n = 0
    for name in {r["bundle"] for r in index.collect()}:
        with open(f"{tmp_path}/a/{name}", "rb") as f:
            data = f.read()
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        records = list(W.parse_records(raw))
        assert records[0][1]["WARC-Type"] == "warcinfo" and all(k["WARC-Type"] != "warcinfo" for _, k, _ in records[1:])
        for _, headers, block in records[1:]:
            assert {"WARC-Record-ID", "WARC-Date", "Content-Type", "WARC-Payload-Digest"} <= set(headers)
            assert re.match(rb"HTTP/1.1 200 OK\r\n", block)
        n += len(records) - 1
        frames = W.read_seek_table(data)
        body = sum(f[0] for f in frames)
        assert body + 8 + 12 * len(frames) + 9 == len(data) and sum(f[1] for f in frames) == len(raw)
    assert n == len(ROWS)


def test_single_records(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    index = archive(spark, ROWS, folder, frame_bytes=500)
    wanted = index.where("page_id in (1, 9, 13)").select("record_id")
    got = {r["page_id"]: r for r in W.fetch_records(index, wanted.unionByName(wanted), folder).collect()}
    assert set(got) == {1, 9, 13} and got[1]["payload"] == LONG and got[13]["payload"] == "é" * 400_000
    assert got[9]["refers_to_id"] == got[1]["record_id"] == W.payload_id(hashlib.sha256(LONG.encode()).hexdigest())
    assert W.fetch_records(index, spark.createDataFrame([("<urn:uuid:none>",)], "record_id string"), folder).count() == 0


def test_damage_is_seen(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    index = archive(spark, [(1, "u", LONG)], folder, level=1)
    path = f"{tmp_path}/a/{index.first()['bundle']}"
    data = bytearray(open(path, "rb").read())
    (packed, raw, checksum), = W.read_seek_table(bytes(data))
    with open(path, "wb") as f:
        f.write(bytes(data[:packed]) + W.seek_table([(packed, raw, checksum ^ 1)]))
    assert [r["intact"] for r in W.read_bundles(W.bundles(index), folder).collect()] == [False]
    with pytest.raises(ValueError):
        W.read_seek_table(bytes(data[:packed]))


def test_what_lost_tasks_left_is_not_read(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    index = archive(spark, ROWS[:4], folder)
    with open(f"{tmp_path}/a/bundles/orphan.warc.zst", "wb") as f:
        f.write(b"half a bundle")
    assert W.read_bundles(W.bundles(index), folder).count() == 4


def test_seek_table_of_many_frames():
    """One that is longer than what the reader takes at first."""
    frames = [(i + 1, 2 * i, 3 * i) for i in range(9000)]
    data = b"x" * 50 + W.seek_table(frames)
    need = W.read_seek_table(data[-(1 << 16):])
    assert isinstance(need, int) and W.read_seek_table(data[-need:]) == frames


def test_empty_and_clashing(spark, tmp_path):
    folder = f"file://{tmp_path}/a"
    index = archive(spark, [], folder)
    assert index.count() == 0 and W.read_bundles(W.bundles(index), folder).count() == 0
    pages = spark.createDataFrame([(1, "u", LONG), (2, "u", LONG)], SCHEMA)
    for name in ("digest", "payload", "row", "n", "first", "at", "record_type", "missing"):
        pages = pages.withColumn(name, F.lit("x"))
    assert W.archive_records(pages).groupBy("record_type").count().count() == 2
