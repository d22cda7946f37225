import base64
import glob
import hashlib
import io
import random

import pytest
import zstandard
from llm_cases import clashing

from chatloom.llm import warc as op

SCHEMA = "page_id long, url string, html string"


def plain(rows, min_bytes=0):
    """Sorted (page_id, bytes, digest, type, refers_to) of (page_id, url, html) rows."""
    body = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, b in body:
        if i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, b in body:
        refers = first.get(b) if len(b) >= min_bytes and first.get(b) != i else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def pages(rng, n=300):
    rows = []
    for i in range(n):
        html = "".join(rng.choices(["<p>", "é", "日本", "word ", "\r\n\r\n", "\x00", "P*M\x18\x00\x00\x00\x00", "WARC/1.1\r\n"], k=rng.randint(0, 60)))
        rows.append((i * 3 % n, f"http://h{i}.example/{i}?q=é \r\nX: {i}", html))
    rows += [(1000 + i, None, rows[7][2]) for i in range(20)] + [(2000, "", None), (2001, None, ""), (2002, "u", "x" * 3_000_000)]
    rows += [(1000, None, rows[7][2]), (None, None, rows[7][2]), (None, None, "nobody else"), (None, None, "nobody else")]
    return rows


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_bytes", [0, 40])
def test_round_trip(spark, tmpdir_fresh, min_bytes):
    rows = pages(random.Random(9))
    df = clashing(spark.createDataFrame(rows, SCHEMA), "page", "class", "refers", "payload_bytes", "html2", "_first")
    out = op.write_archives(df, f"{tmpdir_fresh}/w", min_bytes=min_bytes, archive_bytes=1 << 20)
    assert out.columns == ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert result(out) == plain(rows, min_bytes)
    full = op.read_archives(spark, f"{tmpdir_fresh}/w", "long", with_payload=True).where("record_type = 'response'").collect()
    html = {}
    for i, _, h in rows:
        html.setdefault(i, set()).add((h or "").encode())
    assert all(bytes(r.payload) in html[r.page_id] for r in full)
    assert any(r.url == "http://h0.example/0?q=%C3%A9%20%0D%0AX:%200" for r in full)


def test_archives_are_plain_zstandard_with_a_frame_a_record(spark, tmpdir_fresh):
    rows = [(i, f"http://e/{i}", f"<html><head><title>page {i}</title></head><body>{'text of the page ' * 30}{i}</body></html>") for i in range(2000)]
    op.write_archives(spark.createDataFrame(rows, SCHEMA), f"{tmpdir_fresh}/w", dict_bytes=4096, sample_bytes=1 << 20)
    files = glob.glob(f"{tmpdir_fresh}/w/*.warc.zst")
    assert len(files) > 1 and not glob.glob(f"{tmpdir_fresh}/w/*.txt")
    n = 0
    for f in files:
        data = open(f, "rb").read()
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        size = int.from_bytes(data[4:8], "little")
        words = zstandard.ZstdCompressionDict(data[8:8 + size])
        assert words.dict_id() and size <= 4096
        frames = data[8 + size:].split(op.GAP)[1:-1]
        for k, frame in enumerate(frames):  # any record by itself
            rec = zstandard.ZstdDecompressor(dict_data=words).decompress(frame)
            assert rec.startswith(b"WARC/1.1\r\nWARC-Type: " + (b"response" if k else b"warcinfo")) and rec.endswith(b"\r\n\r\n")
        n += len(frames) - 1
        assert len(data) < 0.5 * sum(len(zstandard.ZstdDecompressor(dict_data=words).decompress(x)) for x in frames)
    assert n == 2000


def test_archives_of_others(spark, tmpdir_fresh):
    rec = op.record("5", "u", b"body", op.base32(hashlib.sha1(b"body").digest()), None, "2020-01-01T00:00:00Z")
    words = b"WARC-Type: response " * 20
    packed = zstandard.ZstdCompressor().compress(words)
    with_dict = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(words)).compress(rec)
    for data in (zstandard.ZstdCompressor().compress(rec), op.DICT_MAGIC + len(packed).to_bytes(4, "little") + packed + with_dict * 2):
        assert all(op.page_of(*r)[:6] == ("5", "u", 4, op.base32(hashlib.sha1(b"body").digest()), "response", None) for r in op.archive_records(data))
    broken = zstandard.ZstdCompressor().compress(rec.replace(b"body", b"bod!"))
    with pytest.raises(ValueError):
        [op.page_of(*r) for r in op.archive_records(broken)]
    with pytest.raises(ValueError):
        list(op.archive_records(zstandard.ZstdCompressor().compress(rec[:-7])))
    assert isinstance(io.BytesIO(), io.IOBase)


def test_empty_table_one_row_and_string_ids(spark, tmpdir_fresh):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.write_archives(empty, f"{tmpdir_fresh}/e").collect() == []
    one = spark.createDataFrame([(1, None, None)], SCHEMA)
    assert result(op.write_archives(one, f"{tmpdir_fresh}/o")) == plain([(1, None, None)])
    named = spark.createDataFrame([("b:1", "u", "x"), ("a:2", "u", "x"), ("c", "u", "y")], "page_id string, url string, html string")
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in op.write_archives(named, f"{tmpdir_fresh}/s").collect())
    assert got == [("a:2", "response", None), ("b:1", "revisit", "a:2"), ("c", "response", None)]
