import base64
import gzip
import hashlib
import zlib

import pytest

from sluice.llm import warc as W
from sluice.session import shared_dir

SCHEMA = "page_id long, url string, html string"
ROWS = [(1, "http://a/x y", "<p>one</p>"), (2, "http://b/é\n", "<p>one</p>"), (3, None, None), (4, "", ""), (5, "http://c", "löng " * 90000),
        (5, "http://c", "löng " * 90000), (7, "http://d", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://e", "<p>one</p>"), (None, "http://f", "only null"),
        (None, "http://f", "only null"), (9, "http://g", "single"), (10, "u", "same id, other text"), (10, "u", "another text")]


def pages(spark, rows=ROWS, extra=True):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 as same", "'x' as keep", "2 as archive", "3 as refers_to", "4 as at") if extra else df


def plain(rows, least=0):
    """Digest, type and reference of each row by a scan of all rows."""
    out = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        ids = [i for i, _, h in rows if i is not None and (h or "") == (html or "")]
        refers = max(ids) if ids and len(raw) >= least and max(ids) != page_id else None
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page_id, len(raw), sha, "response" if refers is None else "revisit", refers))
    return out


def key(r):
    return tuple(str(x) for x in r)


def test_report_equals_a_scan_of_all_rows(spark):
    assert sorted(map(key, W.report(pages(spark)).collect())) == sorted(map(key, plain(ROWS)))
    assert W.report(pages(spark, [])).collect() == []
    assert "AAAA" not in {r.payload_digest for r in W.report(pages(spark)).collect()}


def test_payloads_under_the_threshold_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    got = W.read(W.archive_pages(pages(spark, rows), least=4)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(key, got.collect())) == sorted(map(key, plain(rows, least=4)))


def test_whole_files_become_members_with_an_index(spark):
    root = shared_dir(spark, "t-warc")
    whole = W.write(W.decided(pages(spark).coalesce(1)), root, archive_bytes=400_000)
    for r in whole.collect():
        raw = open(r.archive.removeprefix("file:"), "rb").read()
        d = zlib.decompressobj(31)
        assert len(d.decompress(raw)) == r.bytes and d.eof and not d.unused_data  # one member over the whole file
    assert whole.count() >= 3 and sum(r.records for r in whole.collect()) == len(ROWS)
    normal = W.normalise(whole, root)
    for r in normal.collect():
        raw = open(r.archive.removeprefix("file:"), "rb").read()
        lines = [x.split("\t") for x in open(r.sidecar.removeprefix("file:")).read().splitlines()]
        end = 0
        for at, length, kind, _ in lines:
            assert int(at) == end  # the members fill the file
            end += int(length)
            d = zlib.decompressobj(31)
            text = d.decompress(raw[int(at):end])
            assert d.eof and not d.unused_data and text.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and text.endswith(b"\r\n\r\n")
        assert end == len(raw) == r.bytes and len(lines) == r.records
    # the same inflated bytes before and after, and a normalised archive can be normalised again
    inflate = lambda df: sorted(gzip.decompress(open(r.archive.removeprefix("file:"), "rb").read()) for r in df.collect())
    assert inflate(whole) == inflate(normal) == inflate(W.normalise(normal, root))
    assert sorted(map(key, W.read(normal).collect()))[0][:5] == sorted(map(key, plain(ROWS)))[0]


@pytest.mark.parametrize("size", [1, 2, 7, 100, 10**6])
def test_records_are_cut_alike_whatever_the_chunks(size):
    raw = b"".join(W.record(i, "http://x", (h or "").encode(), None if i != 2 else 1) for i, _, h in ROWS[:4])
    heads, blocks = [], []
    for kind, value in W.pieces(raw[i:i + size] for i in range(0, len(raw), size)):
        if kind == "head":
            heads.append(value[0]["warc-record-id"])
            blocks.append(b"")
        elif kind == "block":
            blocks[-1] += value
    assert heads == [f"<urn:page:{i}>" for i, _, _ in ROWS[:4]]
    assert blocks[0].endswith(b"<p>one</p>") and blocks[1].endswith(b"Content-Length: 10\r\n\r\n")


def test_cut_off_archives_are_refused(tmp_path):
    raw = W.record(1, "http://x", b"payload", None)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(gzip.compress(raw)[:-12])
    with pytest.raises(ValueError, match="cut off"):
        W.normalise_one(str(path), str(tmp_path / "b.warc.gz"), 6)
    path.write_bytes(gzip.compress(raw[:-9]))
    with pytest.raises(ValueError, match="within a record"):
        W.normalise_one(str(path), str(tmp_path / "b.warc.gz"), 6)
