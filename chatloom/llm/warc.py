"""Dictionary-compressed WARC archives: written by Spark's own committed writer, read back record by record.

An archive is a zstd file: first a skippable frame with the dictionary, then one frame a record, so any record can
be read by itself with the dictionary at hand.  The writer is Spark's text source, whose rows are the frames' bytes
and whose line separator is an empty skippable frame, which decompressors pass over: failed and speculative tasks
leave no file, on any store.  Page bodies are shuffled once, to deal them to archives of even size.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import cut, prepare
from chatloom.sources.fs import rename_suffix

DICT_MAGIC = (0x184D2A5D).to_bytes(4, "little")  # the skippable frame that holds the dictionary
ZSTD_MAGIC = (0xFD2FB528).to_bytes(4, "little")
GAP = (0x184D2A50).to_bytes(4, "little") + bytes(4)  # a skippable frame of no bytes: all ASCII, so it can be a line separator
SUFFIX = ".warc.zst"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 8192  # bytes; the dictionary's sample is drawn piece by piece, so long pages count by their length
OVERHEAD = 600  # bytes of a record's headers, for planning


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def _urn(page: str, digest: str) -> str:
    return f"<urn:page:{page}:{digest}>"


def _uri(url: str | None) -> str | None:
    """The URL fit for a header line: bytes that would break it are percent-encoded."""
    return None if url is None else re.sub(rb"[\x00-\x20\x7f-\xff]", lambda m: b"%%%02X" % m.group()[0], url.encode("utf-8")).decode("ascii")


def record(page: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the response's HTTP headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page, digest)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to, digest)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    body = b"software: chatloom\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:warcinfo:chatloom>\r\nWARC-Date: {date}\r\n" \
           f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode("ascii") + body + b"\r\n\r\n"


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstd dictionary of at most ``size`` bytes; too few samples to train one serve as a plain prefix themselves."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _write_kernel(dictionary, level: int, date: str):
    def run(batches):
        import pyarrow as pa
        import zstandard
        words = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        if words:
            words.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(level=level, dict_data=words)
        out = [DICT_MAGIC + len(dictionary.value).to_bytes(4, "little") + dictionary.value, packer.compress(_info(date))]
        held, any_row = 0, False
        for b in batches:
            for page, url, html, refers in zip(*(b.column(i) for i in range(4))):
                any_row = True
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                page = "" if not page.is_valid else page.as_py()
                frame = packer.compress(record(page, url.as_py(), payload, base32(hashlib.sha1(payload).digest()), refers.as_py(), date))
                out.append(frame)
                held += len(frame)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, held = [], 0
        if any_row and out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
    return run


def _payload(html: str):
    return F.coalesce(F.col(html).cast("string"), F.lit(""))


def revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``(page, class, refers)``: the rows whose payload a smaller id has as well, with the smallest such id."""
    return _revisits(_narrow(pages, id_col, html_col), min_bytes)


def _narrow(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    return pages.select(F.col(id_col).alias("page"), F.unhex(F.sha2(_payload(html_col).cast("binary"), 256)).alias("class"),
                        F.octet_length(_payload(html_col)).cast("long").alias("n_bytes"))


def _revisits(narrow: DataFrame, min_bytes: int) -> DataFrame:
    first = narrow.where(F.col("n_bytes") >= min_bytes).groupBy(F.col("class").alias("_class")) \
        .agg(F.min("page").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and _first is not null")
    later = F.col("page").isNull() | (F.col("page") > F.col("_first"))
    return narrow.join(first, F.col("class") == F.col("_class")).where(later) \
        .groupBy("page", "class").agg(F.min("_first").alias("refers"))


def sample_records(pages: DataFrame, total: int, id_col: str, url_col: str, html_col: str, sample_bytes: int, date: str) -> list[bytes]:
    """About ``sample_bytes`` of the records, as pieces drawn by hash; the first piece of a page has its headers."""
    body, octets = _payload(html_col).cast("binary"), F.octet_length(_payload(html_col))
    share = min(1.0, sample_bytes / max(1, total))
    at = pages.select(F.col(id_col).cast("string").alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("body"),
                      F.explode(F.sequence(F.lit(0), F.floor(F.greatest(octets - 1, F.lit(0)) / PIECE).cast("int"))).alias("no"))
    at = at.where(F.pmod(F.xxhash64("page", "url", "no"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = at.select("page", "url", "no", F.substring("body", F.col("no") * PIECE + 1, F.lit(PIECE)).alias("piece")).collect()
    out = []
    for r in sorted(rows, key=lambda r: (r["page"] or "", r["no"], bytes(r["piece"]))):
        piece = bytes(r["piece"])
        out.append(record(r["page"] or "", r["url"], piece, base32(hashlib.sha1(piece).digest()), None, date) if r["no"] == 0 else piece)
    return out


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, archive_bytes: int = 256 << 20, dict_bytes: int = 64 << 10, sample_bytes: int = 8 << 20,
                   level: int = 3, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write every row as a WARC record to ``folder`` and return the records read back (``read_archives``).

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the smallest id is a response and the others
    revisit it; all other rows are responses.  Payload: the page body in UTF-8, a null body is empty; a null URL has
    no header.  Rows that repeat an id and a payload share their record type (two responses, if the id is the smallest).
    A null id stands after all ids, and is a response where no row with that payload has an id.  The dictionary is
    trained on about ``sample_bytes`` of the records (it changes sizes, no result); archives hold about
    ``archive_bytes`` of records before compression.  An empty table writes no archive.  Extra columns are not read.
    """
    spark = pages.sparkSession
    prepare(spark)
    narrow = cut(_narrow(pages, id_col, html_col))
    n, total = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    id_type = pages.schema[id_col].dataType
    if not n:
        return read_archives(spark, None, id_type)
    total += n * OVERHEAD
    dictionary = spark.sparkContext.broadcast(
        train_dictionary(sample_records(pages, total, id_col, url_col, html_col, sample_bytes, date), dict_bytes))
    parts = max(-(-total // archive_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    body = _payload(html_col)
    # never null, so that the join's own partitioning is the one dealt here
    key = F.coalesce(F.concat(F.lit("i"), F.col("page").cast("string")), F.lit("")).alias("key")
    dealt = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), body.alias("html"),
                         F.unhex(F.sha2(body.cast("binary"), 256)).alias("class")).select("*", key).repartition(parts, "key", "class")
    later = _revisits(narrow, min_bytes).select(key.alias("_key"), F.col("class").alias("_class"), "refers")
    rows = dealt.join(later.hint("shuffle_hash"), (F.col("key") == F.col("_key")) & (F.col("class") == F.col("_class")), "left")
    frames = rows.select(F.col("page").cast("string").alias("page"), "url", "html", F.col("refers").cast("string").alias("refers")) \
        .mapInArrow(_write_kernel(dictionary, level, date), "frame binary")
    # the bytes pass through a string column unchanged; the separator is the empty skippable frame
    frames.select(F.col("frame").cast("string").alias("value")).write.mode("overwrite") \
        .option("lineSep", GAP.decode("ascii")).text(folder)
    rename_suffix(spark, folder, ".txt", SUFFIX)
    return read_archives(spark, folder, id_type)


def archive_records(data: bytes):
    """Yield ``(headers, block)`` of each record of an archive's bytes; header names are lower-cased."""
    import zstandard
    words = None
    if data[:4] == DICT_MAGIC:
        size = int.from_bytes(data[4:8], "little")
        raw = data[8:8 + size]
        if raw[:4] == ZSTD_MAGIC:  # the dictionary itself may be compressed
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        words = zstandard.ZstdCompressionDict(raw) if raw else None
        data = memoryview(data)[8 + size:]
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=words).stream_reader(io.BytesIO(data), read_across_frames=True), 1 << 17)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode("ascii")] = value.strip().decode("utf-8")
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("archive ends inside a record")
        yield headers, block


def _id_of(urn: str) -> str | None:
    return urn[len("<urn:page:"):].rpartition(":")[0] or None


def page_of(headers: dict, block: bytes) -> tuple:
    """``(page, url, payload_bytes, digest, type, refers, payload)`` of a record; a response's payload is checked."""
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\ncontent-length: *(\d+)", http).group(1))
    if kind == "response" and (len(payload) != size or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} does not match its headers")
    refers = _id_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return (_id_of(headers["warc-record-id"]), headers.get("warc-target-uri"), size, digest, kind, refers,
            payload if kind == "response" else None)


def _read_kernel(with_payload: bool):
    def run(batches):
        import pyarrow as pa
        schema = pa.schema([("page", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers", pa.string()), *([("payload", pa.binary())] if with_payload else [])])
        for b in batches:
            for content in b.column(0):
                held, size = [], 0
                for headers, block in archive_records(content.as_buffer().to_pybytes()):
                    if headers["warc-type"] not in ("response", "revisit"):
                        continue
                    held.append(page_of(headers, block)[:len(schema)])
                    size += 200 + (len(block) if with_payload else 0)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
    return run


def read_archives(spark: SparkSession, folder: str | None, id_type="string", with_payload: bool = False) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload])`` of the archives in a folder.

    One row per response and revisit record, sizes and digests being those of the full payload; a response whose
    payload doesn't match its headers fails the job.  ``payload`` is null for revisits.  An archive is read by one
    task, as a stream of records; archives of other writers may have no dictionary or a compressed one.
    """
    prepare(spark)
    if folder is None:
        files = spark.createDataFrame([], "content binary")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("content")
    rows = files.mapInArrow(_read_kernel(with_payload), "page string, url string, payload_bytes long, payload_digest string, "
                            "record_type string, refers string" + (", payload binary" if with_payload else ""))
    return rows.select(F.col("page").cast(id_type).alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type",
                       F.col("refers").cast(id_type).alias("refers_to"), *(["payload"] if with_payload else []))
