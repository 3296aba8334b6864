"""Web archives against plain grouping, the format's own decoder and seeks."""
import base64
import collections
import hashlib
import io
import struct

import pytest
import zstandard

from riskloom.llm import warc
from riskloom.llm.queries import QUERIES

SCHEMA = "page_id bigint, url string, html string, sha string, copies int, own string"


def plain(rows, least=0):
    groups = collections.defaultdict(list)
    for page, _, html in rows:
        groups[html or ""].append(page)
    out = collections.Counter()
    for html, pages in groups.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        pages = sorted(pages, key=lambda p: (p is not None, p or 0))
        for i, p in enumerate(pages):
            revisit = len(data) >= least and i < len(pages) - 1
            out[p, len(data), digest, "revisit" if revisit else "response", pages[-1] if revisit else None] += 1
    return out


ODD = [
    (1, "http://a", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (4, "http://c", ""), (5, "x\r\ny%", "Ü 漢字 \U0001f389\r\n\r\nWARC/1.1"),
    (6, "http://d", "long " * 300_000), (7, "http://e", "long " * 300_000), (8, "http://f", "same"), (8, "http://f", "same"), (8, "http://g", "same"),
    (None, "http://h", "no key"), (None, "http://h", "no key"), (None, None, "same"), (9, "http://i", "short"), (9, "http://i", "other page 9"),
]


def frame_of(spark, rows):
    return spark.createDataFrame([(p, u, h, "s", 1, "o") for p, u, h in rows], SCHEMA)


def got(df):
    return collections.Counter(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()))


def test_archives_of_pages(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op13_seekable_warc"](spark, folder)) == plain(rows)


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_archives_of_odd_rows(spark, least):
    rows = ODD + [(100 + i, "http://hot", "hot page") for i in range(200)] + [(50, "u", "equal rows")] * 40
    assert got(warc.archived(frame_of(spark, rows).repartition(4), least=least)) == plain(rows, least)
    assert warc.archived(frame_of(spark, [])).count() == 0


def test_bundles_are_zstandard_streams_with_seek_tables(spark, tmp_path):
    rows = ODD + [(100 + i, f"http://{i}", f"page {i} " * 50) for i in range(500)]
    folder = str(tmp_path / "archive")
    index = warc.write_archives(frame_of(spark, rows).coalesce(1), folder, frame_bytes=4_000, bundle_bytes=10_000).collect()
    files = {r.file for r in index}
    assert len(files) > 2 and len({r.record_id for r in index}) == len(rows)
    for name in files:
        data = (tmp_path / "archive" / name).read_bytes()
        with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as stream:
            whole = stream.read()  # a decoder that knows nothing of the seek table
        own = [r for r in index if r.file == name]
        assert sum(r.length for r in own) == len(whole)
        frames, _, magic = struct.unpack("<IBI", data[-9:])
        assert magic == 0x8F92EAB1 and frames == len({r.frame for r in own})
        reader = warc.Reader(f"{folder}/{name}")
        assert b"".join(reader.frame(i) for i in range(frames)) == whole
        for r in own:
            piece = reader.frame(r.frame)[r.offset:r.offset + r.length]
            assert piece.startswith(b"WARC/1.1\r\n") and f"<{r.record_id}>".encode() in piece


def test_records_are_fetched_by_seeking(spark, tmp_path, monkeypatch):
    rows = [(i, f"http://{i}", f"page {i // 2} " * 200) for i in range(300)]
    index = warc.write_archives(frame_of(spark, rows), str(tmp_path / "a"), frame_bytes=9_000)
    found = warc.fetch(index.where("page_id in (3, 4, 250, 251)"), str(tmp_path / "a")).collect()
    assert {r.page_id: (r.record_type, r.payload and bytes(r.payload).decode()) for r in found} == {
        3: ("response", "page 1 " * 200), 4: ("revisit", None), 250: ("revisit", None), 251: ("response", "page 125 " * 200),
    }
    assert index.select("file", "frame").distinct().count() > 10


def test_damaged_bundles_are_refused(spark, tmp_path):
    folder = str(tmp_path / "a")
    index = warc.write_archives(frame_of(spark, ODD[:3]).coalesce(1), folder)
    path = tmp_path / "a" / index.first().file
    data = path.read_bytes()
    path.write_bytes(data[:-1] + b"\0")
    with pytest.raises(ValueError, match="seek table"):
        warc.Reader(str(path))
    head, http, payload = next(warc.records(warc.record("urn:x", 1, "u", b"abc", warc.payload_digest(b"abc"), None)))
    assert warc._fields(head, http, payload)[1] == 3
    assert head["WARC-Target-URI"] == "u"
    odd = warc.record("urn:x", 1, "http://a/%20b\r\nX-Header: 1", b"", warc.payload_digest(b""), None)
    assert next(warc.records(odd))[0]["WARC-Target-URI"] == "http://a/%20b%0D%0AX-Header: 1"
    with pytest.raises(ValueError, match="digest"):
        warc._fields(head, http, b"abd")
