"""WARC archives with a zstd dictionary: one frame a record, written by tasks and read back record by record."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Marks, Scratch, bounded, read, shared_dir

#: Magic numbers of the format: the skippable frame with the dictionary, a zstd frame, a zstd dictionary.
DICTIONARY_FRAME, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: The dictionary is fitted on so many pages at most, of so many bytes at most, and has so many bytes.
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 1 << 16, 1 << 15
LEVEL = 3
#: Bytes that are read from an archive at once.
CHUNK = 1 << 20
#: The longest header of a record, in bytes.
HEADER = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_NAME = re.compile(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+")


class ArchiveError(ValueError):
    """An archive that breaks the format: where and how."""


def fit_dictionary(pages: DataFrame) -> bytes:
    """A dictionary fitted on a bounded sample: the SAMPLE pages whose ids have the least hashes, those of SAMPLE_BYTES at most; empty if they are too few.

    It only makes records smaller: what is read back doesn't depend on it.
    """
    ids = [r["page_id"] for r in pages.select("page_id").filter("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE).collect()]
    small = pages.filter(F.col("page_id").isin(ids) & (F.octet_length("html") <= SAMPLE_BYTES)).select("html").limit(2 * SAMPLE) if ids else None
    sample = [r["html"].encode() for r in small.collect() if r["html"]] if ids else []
    if len(sample) < 8 or sum(map(len, sample)) < 4 * DICTIONARY_BYTES:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()


def leading_frame(dictionary: bytes) -> bytes:
    """The skippable frame that opens an archive, with the dictionary compressed in it; nothing without a dictionary."""
    if not dictionary:
        return b""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body


def record(page_id, url: str | None, payload: bytes | None, digest: str, length: int, refers_to, date: str) -> bytes:
    """A response with its payload, or (payload None) a revisit with the response's HTTP header alone. Control characters of a URL are escaped."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload or b"")
    known = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
    ]
    if payload is None:
        known += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{refers_to}:{digest}')}>"), ("Page-Refers-To", quote(str(refers_to)))]
    known += [("Page-ID", None if page_id is None else quote(str(page_id))), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in known if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _filesystem(uri: str):
    """A file system that pyarrow opens, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri) if ":" in uri else os.path.abspath(uri))


def write_archives(records: DataFrame, folder: str, dictionary: bytes, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One archive a partition; (path, records, bytes) of those that belong to the result.

    records: page_id, url, html (null in revisits), digest, payload_bytes, refers_to. A task writes under a name of its own attempt, and only the
    names that Spark's own write of this table commits count: a lost or repeated attempt leaves a file that nobody reads. Keep the table.
    """
    bounded(records.sparkSession)

    def write(batches):
        name = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.zst"
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True, write_content_size=True)
        out, n = None, 0
        for b in batches:
            for page_id, url, html, digest, length, refers in zip(*(b.column(c) for c in ("page_id", "url", "html", "digest", "payload_bytes", "refers_to")), strict=True):
                if out is None:
                    system, path = _filesystem(name)
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(path, compression=None)
                    out.write(leading_frame(dictionary))
                payload = html.as_buffer().to_pybytes() if html.is_valid else None
                out.write(coder.compress(record(page_id.as_py(), url.as_py(), payload, digest.as_py(), length.as_py(), refers.as_py(), date)))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [n], "bytes": [size]}, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return records.select("page_id", "url", "html", "digest", "payload_bytes", "refers_to").mapInArrow(write, "path string, records long, bytes long")


def frames(stream, name: str = "") -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each frame of an archive, read in chunks; a leading skippable frame gives the dictionary, others are passed over."""
    held, offset, dictionary, first = b"", 0, None, True

    def need(n: int) -> bool:
        nonlocal held
        pieces, have = [held], len(held)
        while have < n and (more := stream.read(max(CHUNK, n - have))):
            pieces.append(more)
            have += len(more)
        held = b"".join(pieces)
        return have >= n

    while need(1):
        if not need(4):
            raise ArchiveError(f"{name} at {offset}: {len(held)} bytes after the last frame")
        magic = int.from_bytes(held[:4], "little")
        if magic & ~0xF == 0x184D2A50:
            if not need(8) or not need(8 + (n := int.from_bytes(held[4:8], "little"))):
                raise ArchiveError(f"{name} at {offset}: a skippable frame is cut short")
            if first and magic == DICTIONARY_FRAME:
                dictionary = _dictionary(held[8 : 8 + n], f"{name} at {offset}")
            held, offset = held[8 + n :], offset + 8 + n
        elif magic == FRAME:
            decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            pieces, used = [], 0
            try:
                while not decoder.eof:
                    if not held and not need(1):
                        raise ArchiveError(f"{name} at {offset}: a frame is cut short")
                    pieces.append(decoder.decompress(held))
                    used += len(held) - len(decoder.unused_data)
                    held = decoder.unused_data
            except zstandard.ZstdError as e:
                raise ArchiveError(f"{name} at {offset}: {e}") from e
            yield offset, b"".join(pieces)
            offset += used
        else:
            raise ArchiveError(f"{name} at {offset}: {magic:#010x} begins no frame")
        first = False


def _dictionary(body: bytes, where: str) -> zstandard.ZstdCompressionDict:
    """The dictionary in a skippable frame, as it is or compressed."""
    magic = int.from_bytes(body[:4], "little")
    if magic == FRAME:
        try:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        except zstandard.ZstdError as e:
            raise ArchiveError(f"{where}: the dictionary can't be read: {e}") from e
        magic = int.from_bytes(body[:4], "little")
    if magic != DICTIONARY:
        raise ArchiveError(f"{where}: the leading frame has no dictionary")
    return zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT)


def _fields(lines: list[bytes], where: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not _NAME.fullmatch(name):
            raise ArchiveError(f"{where}: no header line: {line[:80]!r}")
        key = name.decode("ascii", "replace").lower()
        if key in out:
            raise ArchiveError(f"{where}: {key} stands twice")
        out[key] = value.strip(b" \t").decode()
    return out


def _length(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not re.fullmatch("[0-9]+", value):
        raise ArchiveError(f"{where}: content-length is {value!r}")
    return int(value)


def parse(content: bytes, where: str = "") -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and the length of the full payload of one record, all checked: version, mandatory headers, block length and digest, what
    follows the block, and the HTTP length; a response's payload has the length and the digest that its headers say."""
    end = content.find(b"\r\n\r\n", 0, HEADER)
    if end < 0:
        raise ArchiveError(f"{where}: the header has no end")
    first, *lines = content[:end].split(b"\r\n")
    if first not in (b"WARC/1.0", b"WARC/1.1"):
        raise ArchiveError(f"{where}: no record begins with {first[:20]!r}")
    fields = _fields(lines, where)
    if missing := [k for k in ("warc-type", "warc-record-id", "warc-date", "content-length") if k not in fields]:
        raise ArchiveError(f"{where}: {', '.join(missing)} missing")
    n, begin = _length(fields, where), end + 4
    block = content[begin : begin + n]
    if len(block) != n or content[begin + n :] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: content-length is {n}, but {len(content) - begin - 4} bytes stand before the frame's end")
    if (told := fields.get("warc-block-digest", "")).startswith("sha256:") and told[7:] != hashlib.sha256(block).hexdigest():
        raise ArchiveError(f"{where}: the block's digest is another")
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, block, len(block)
    split = block.find(b"\r\n\r\n")
    status, *lines = block[: max(0, split)].split(b"\r\n")
    if split < 0 or not status.startswith(b"HTTP/"):
        raise ArchiveError(f"{where}: the block has no HTTP header")
    full, payload = _length(_fields(lines, where), where), block[split + 4 :]
    if fields["warc-type"] == "response":
        if len(payload) != full:
            raise ArchiveError(f"{where}: the payload has {len(payload)} of {full} bytes")
        if (told := fields.get("warc-payload-digest", "")).startswith("sha256:") and told[7:] != hashlib.sha256(payload).hexdigest():
            raise ArchiveError(f"{where}: the payload's digest is another")
    elif fields["warc-type"] == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ArchiveError(f"{where}: a revisit has a payload or refers to nothing")
    return fields, payload, full


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the archives at `path`: path, offset, record_type, page_id, url, payload_digest, payload_bytes, refers_to, payload.

    An archive is read by one task, in chunks, a record at a time. What breaks the format is an ArchiveError. page_id and refers_to are strings;
    payload is null in revisits, and everywhere without `payloads`.
    """
    spark = archives.sparkSession
    bounded(spark)
    n = max(1, archives.count())
    kind = pa.schema([("path", pa.string()), ("offset", pa.int64()), *((c, pa.string()) for c in ("record_type", "page_id", "url", "payload_digest")), ("payload_bytes", pa.int64()), ("refers_to", pa.string()), ("payload", pa.binary())])

    def scan(batches):
        for b in batches:
            for name in b.column("path").to_pylist():
                system, path = _filesystem(name)
                rows, size = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for offset, content in frames(stream, name):
                        fields, payload, full = parse(content, f"{name} at {offset}")
                        page = lambda key, fields=fields: unquote(fields[key]) if key in fields else None
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                        rows.append((name, offset, fields["warc-type"], page("page-id"), fields.get("warc-target-uri"), digest, full, page("page-refers-to"), payload if payloads and fields["warc-type"] != "revisit" else None))
                        size += 256 + (len(payload) if payloads else 0)
                        if size > CHUNK:
                            yield _rows(rows, kind)
                            rows, size = [], 0
                if rows:
                    yield _rows(rows, kind)

    return archives.select("path").repartitionByRange(n, "path").mapInArrow(scan, "path string, offset long, record_type string, page_id string, url string, payload_digest string, payload_bytes long, refers_to string, payload binary")


def _rows(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def _marked(rows: DataFrame, marks, key: str, wanted: bool) -> DataFrame:
    """Rows whose 64-bit key a bitmap marks, or the others."""

    def run(batches):
        for b in batches:
            hit = marks.value.hit(b.column(key).to_numpy())
            yield b.filter(pa.array(hit == wanted))

    return rows.mapInArrow(run, rows.schema)


def records_of(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """page_id, url, html (null in revisits), digest, payload_bytes and refers_to of each page: the record that it is to be.

    Pages with a payload of LEAST bytes that others have too are told from the rest by a bitmap of the payloads' hashes. Only their ids and digests
    are shuffled to decide; then the html of the responses among them, one a payload. A payload that more than a thousandth of those pages have is
    joined by broadcast (so there are fewer than a thousand such payloads), so that no task gets all its pages. Null html is an empty payload. Rows with the
    least page_id of a payload are all responses, should it be there twice; a null page_id is after all others.
    """
    spark = pages.sparkSession
    bounded(spark)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    x = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"))
    x = x.withColumns({"digest": F.sha2("html", 256), "payload_bytes": F.octet_length("html").cast("long")})
    of_digest, of_row = F.xxhash64("digest").alias("key"), F.xxhash64("digest", "page_id").alias("key")
    slim = x.select("page_id", "url", "digest", "payload_bytes", of_digest)
    groups = scratch.save(slim.filter(F.col("payload_bytes") >= LEAST).groupBy("digest", "key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null"), "warc-payloads")
    marks = spark.sparkContext.broadcast(Marks(groups))
    same = _marked(slim, marks, "key", True).drop("key")
    total = groups.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > total / 1000
    hot = same.join(F.broadcast(groups.filter(often).select("digest", "first")), "digest", "left")
    rare = hot.filter("first is null").drop("first").join(groups.filter(~often).select("digest", "first"), "digest", "left")
    columns = ["page_id", "url", "digest", "payload_bytes", "first"]
    decided = scratch.save(hot.filter("first is not null").select(columns).unionByName(rare.select(columns)), "warc-decided")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    revisits = decided.filter(again).select("page_id", "url", F.lit(None).cast("string").alias("html"), "digest", "payload_bytes", F.col("first").alias("refers_to"))
    firsts = decided.filter(~again).select("digest", "page_id", of_row).distinct()
    whole = x.withColumns({"key": F.xxhash64("digest"), "row": F.xxhash64("digest", "page_id")})
    alone = _marked(whole, marks, "key", False)
    wanted = spark.sparkContext.broadcast(Marks(firsts))
    once = _marked(_marked(whole, marks, "key", True), wanted, "row", True)
    one = firsts.select(F.col("digest").alias("d"), F.col("page_id").alias("p"))
    once = once.join(one, (F.col("digest") == F.col("d")) & F.col("page_id").eqNullSafe(F.col("p")), "left_semi")
    responses = alone.unionByName(once).select("page_id", "url", "html", "digest", "payload_bytes", F.lit(None).cast(pages.schema["page_id"].dataType).alias("refers_to"))
    return responses.unionByName(revisits)


def op13_warc(spark, sf_dir):
    """All pages written as WARC records and read back: page_id, payload_bytes, payload_digest, record_type, refers_to; a row a page.

    An empty table gives no archives and no rows.
    """
    scratch = Scratch()
    pages = read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    records = records_of(pages, scratch)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = scratch.save(write_archives(records, folder, fit_dictionary(pages)), "warc-archives")
    back = read_archives(archives, payloads=False).filter(F.col("record_type").isin("response", "revisit"))
    back = back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    out = scratch.result(back, "warc-result")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return out
