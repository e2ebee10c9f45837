import gzip
import hashlib
import io

import pytest

from payscope.llm import warc

BIG = "<html>" + "ä" * 200


def pages(spark, rows, path, parts=3):
    spark.createDataFrame(rows, "page_id long, url string, html string, file string").repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("span", [64, 1000, 1 << 20])
def test_round_trip_in_ranges(spark, tmp_path, span):
    rows = [(i, f"http://x/{i}?a=b c\r\n", f"<p>{i % 7}" * (30 + i % 7) if i % 3 else f"short {i % 2}", "f") for i in range(1, 120)]
    rows += [(200, None, None, "f"), (201, "u", "", "f"), (None, "u", BIG, "f"), (300, "u", BIG, "f"), (301, "u", BIG, "f"), (300, "u", BIG, "f")]
    docs = pages(spark, rows, str(tmp_path / "in"))
    folder = str(tmp_path / "warc")
    files = warc.write_warc(docs, folder)
    got = warc.read_warc(spark, folder, files, span).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    want = []
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and i != first[html or ""]
        want.append((i, "revisit" if revisit else "response", first[html or ""] if revisit else None, len(raw), hashlib.sha256(raw).hexdigest(), None if revisit else raw))
    have = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_files_are_plain_warc(spark, tmp_path):
    docs = pages(spark, [(1, "http://x/", BIG, "f"), (2, "http://y/", BIG, "f")], str(tmp_path / "in"), 1)
    files = warc.write_warc(docs, str(tmp_path / "warc")).collect()
    text = b"".join(gzip.open(tmp_path / "warc" / f.file).read() for f in files)
    assert text.count(b"WARC/1.1\r\n") == 2 and text.count(b"WARC-Type: revisit") == 1 and text.endswith(b"\r\n\r\n")


def test_magic_inside_a_member_is_no_record():
    import zlib

    inner = gzip.compress(b"not a record") + warc.MAGIC * 20
    body = warc.record(1, "u", b"", None, "d")
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    first = stored.compress(body.replace(b"\r\n\r\n\r\n\r\n", b"\r\n\r\n" + inner + b"\r\n\r\n", 1)) + stored.flush()
    data = first + gzip.compress(warc.record(2, "u", b"x" * 300, None, "d")) + b"junk" + warc.MAGIC
    got = [f["page-id"] for f, _ in warc.records_in(io.BytesIO(data), len(data), 0, len(data))]
    assert got == ["1", "2"]
    later = [f["page-id"] for f, _ in warc.records_in(io.BytesIO(data), len(data), 5, len(data))]
    assert later == ["2"]
    assert list(warc.records_in(io.BytesIO(data), len(data), 0, 0)) == []


def test_empty(spark, tmp_path):
    docs = pages(spark, [(1, "u", "x", "f")], str(tmp_path / "in")).limit(0)
    files = warc.write_warc(docs, str(tmp_path / "warc"))
    assert files.count() == 0 and warc.read_warc(spark, str(tmp_path / "warc"), files).count() == 0


def test_long_url_is_read_back(spark, tmp_path):
    urls = {1: "http://x/" + "ä" * 400_000, 2: "http://x/" + "a" * (3 << 20), 3: "u"}
    docs = pages(spark, [(i, u, BIG * i, "f") for i, u in urls.items()], str(tmp_path / "in"), 1)
    folder = str(tmp_path / "warc")
    files = warc.write_warc(docs, folder)
    got = warc.complete(warc.read_warc(spark, folder, files, span=1000), files).collect()
    assert {r.page_id: (bytes(r.payload).decode(), len(r.url)) for r in got} == {i: (BIG * i, 9 + 6 * 400_000 if i == 1 else len(u)) for i, u in urls.items()}
    with pytest.raises(RuntimeError, match="3 records read of 4"):
        warc.complete(warc.read_warc(spark, folder, files), files.selectExpr("records + 1 records"))


def test_archives_of_others(spark, tmp_path):
    """Names in any case, fields without a space, revisits without a length, other types."""
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    parts = [
        (["WARC-Type: warcinfo", "content-length: 9"], b"software:"),
        (["warc-type:response", "WARC-RECORD-ID: <urn:1>", "CONTENT-LENGTH:%d" % (len(http) + 4)], http + b"body"),
        (["Warc-Type: revisit", "Content-length: %d" % len(http)], http),
        (["WARC-Type: revisit", "WARC-Payload-Digest: sha1:ABC", "Content-Length: 0"], b""),
        (["Content-Length: 1"], b"?"),
    ]
    folder = tmp_path / "foreign"
    folder.mkdir()
    for name in ("one.warc.gz", "two.warc.gz"):
        (folder / name).write_bytes(b"".join(gzip.compress("\r\n".join(["WARC/1.0", *head]).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") for head, block in parts))
    (folder / "notes.txt").write_text("no archive")
    files = warc.archives(spark, str(folder))
    assert sorted(r.file for r in files.collect()) == ["one.warc.gz", "two.warc.gz"]
    got = warc.read_warc(spark, str(folder), files, span=100)
    rows = sorted(((r.record_type, r.record_id, r.payload_bytes, r.payload_digest, r.payload) for r in got.collect()), key=str)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    want = [("warcinfo", None, 9, digest(b"software:"), b"software:"), ("response", "<urn:1>", 4, digest(b"body"), b"body"),
            ("revisit", None, None, None, None), ("revisit", None, None, "sha1:ABC", None), (None, None, 1, digest(b"?"), b"?")]
    assert rows == sorted(want * 2, key=str)


def test_a_task_per_range(spark, tmp_path):
    docs = pages(spark, [(i, "u", f"{i}" * 5000, "f") for i in range(40)], str(tmp_path / "in"), 2)
    files = warc.write_warc(docs, str(tmp_path / "warc"))
    span = 300
    ranges = sum(-(-r.bytes // span) for r in files.collect())
    read = warc.read_warc(spark, str(tmp_path / "warc"), files, span)
    assert ranges > 8 and read.rdd.getNumPartitions() == ranges and read.count() == 40
