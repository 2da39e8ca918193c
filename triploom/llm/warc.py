"""WARC archives in Zstandard frames with a shared dictionary: writer and reader."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.llm.storage import open_folder, shared_folder, small, stored

DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
PAGE = "urn:triploom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
#: Marks a record whose URI was escaped because it held white space or control characters.
ESCAPED = "X-Target-URI-Escaped"
PLAIN = "!#$&'()*+,/:;=?@[]~"
ROLL_BYTES = 64 << 20
CHUNK = 1 << 20
SAMPLE_ROWS, SAMPLE_BYTES, DICTIONARY_BYTES = 800, 8 << 10, 64 << 10

MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class WarcError(ValueError):
    """A record or frame that doesn't hold what it declares."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from at most ``SAMPLE_ROWS`` payloads, cut to ``SAMPLE_BYTES``.

    It only makes the frames smaller. The hashes of the payloads settle which are taken, so
    tasks send the driver hashes and only the chosen payloads. Equal payloads count once.
    Too little to train on gives plain sample text.
    """
    rows = pages.filter("length(html) > 0").select(F.xxhash64("html").alias("hash"), "html")
    hashes = rows.select("hash").distinct().orderBy("hash").limit(SAMPLE_ROWS)
    chosen = rows.join(F.broadcast(hashes), "hash").select("hash", F.substring("html", 1, SAMPLE_BYTES).alias("html"))
    picked = chosen.dropDuplicates(["hash"]).collect()
    samples = sorted(r["html"].encode()[:SAMPLE_BYTES] for r in picked)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def with_first_page(pages: DataFrame) -> DataFrame:
    """Add ``_first``: the smallest page_id with an equal payload, NULL where there is no other.

    Only digests that occur twice or more are joined back, so the pages themselves are not
    shuffled as long as these fit into a broadcast of checked size.
    """
    keyed = pages.withColumn("_sha", F.sha1(F.coalesce("html", F.lit(""))))
    shared = keyed.groupBy("_sha").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n"))
    shared = stored(shared.filter("_n > 1").drop("_n"), "revisits")
    if small(shared, 100):
        shared = F.broadcast(shared)
    return keyed.join(shared, "_sha", "left").drop("_sha")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """One WARC/1.1 record: a revisit of page ``first`` if that is another page."""
    revisit = first is not None and first != page_id
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        plain = url.isprintable() and " " not in url
        fields.insert(3, ("WARC-Target-URI", url if plain else quote(url, safe=PLAIN)))
        if not plain:  # white space would be lost, so it is escaped; other URLs stand as they are
            fields.append((ESCAPED, "yes"))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{PAGE}{first}>")]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    """The skippable frame that leads an archive; the dictionary in it is compressed."""
    packed = zstandard.ZstdCompressor(level=10).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def _writer(folder: str, dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(folder)
        shared = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True, write_checksum=True)
        lead = dictionary_frame(dictionary)
        out, name, records, size, done = None, "", 0, 0, []
        try:
            for batch in batches:
                columns = [batch.column(c) for c in ("page_id", "url", "html", "_first")]
                for i in range(batch.num_rows):
                    page_id, url, html, first = (c[i].as_py() for c in columns)
                    if out is None:  # a name of its own for each attempt; the manifest counts
                        name = f"{path}/{uuid.uuid4().hex}.warc.zst"
                        out, records, size = files.open_output_stream(name), 0, len(lead)
                        out.write(lead)
                    frame = packer.compress(record_bytes(page_id, url, (html or "").encode(), first))
                    out.write(frame)
                    records, size = records + 1, size + len(frame)
                    if size >= ROLL_BYTES:
                        out.close()
                        done.append((name, records, size))
                        out = None
        finally:
            if out is not None:
                out.close()
                done.append((name, records, size))
        yield pa.RecordBatch.from_pydict(
            {
                "path": pa.array([f"{folder}/{n.rpartition('/')[2]}" for n, _, _ in done], pa.string()),
                "records": pa.array([r for _, r, _ in done], pa.int64()),
                "bytes": pa.array([b for _, _, b in done], pa.int64()),
            }
        )

    return write


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives; the manifest of the files.

    A NULL html is an empty payload. Of pages with equal payloads those with the smallest
    page_id are responses, others are revisits of it; pages without an id are responses if
    no page of the group has one. Files that a lost attempt left are not in the manifest.
    """
    rows = with_first_page(pages.select("page_id", "url", "html"))
    written = rows.mapInArrow(_writer(folder, train_dictionary(pages)), MANIFEST)
    return stored(written, "warc-manifest")


def read_dictionary(head: bytes) -> tuple[bytes, int]:
    """The dictionary in the leading skippable frame and the frame's length."""
    if len(head) < 8:
        raise WarcError("no leading frame")
    magic, length = struct.unpack("<II", head[:8])
    if magic != DICTIONARY_MAGIC:
        raise WarcError(f"leading frame has magic {magic:#x}")
    content = head[8 : 8 + length]
    if len(content) < length:
        raise WarcError("dictionary is cut off")
    if content.startswith(ZSTD_MAGIC):
        content = zstandard.ZstdDecompressor().decompress(content)
    return content, 8 + length


def records_of(stream) -> Iterator[bytes]:
    """The records of an archive, one per frame; ``stream`` is read in pieces."""
    head = stream.read(8)
    if len(head) == 8:
        head += stream.read(struct.unpack("<I", head[4:8])[0])
    dictionary, _ = read_dictionary(head)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    rest = stream.read(CHUNK)
    while rest:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not rest:
                raise WarcError("frame is cut off")
            try:
                parts.append(frame.decompress(rest))
            except zstandard.ZstdError as error:
                raise WarcError(f"bad frame: {error}") from error
            rest = frame.unused_data if frame.eof else stream.read(CHUNK)
        yield b"".join(parts)
        rest = rest or stream.read(CHUNK)


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise WarcError(f"bad header line {line[:80]!r}")
        found[name.strip().lower().decode()] = value.strip().decode()
    return found


def _page(value: str) -> int | None:
    if not (value.startswith(f"<{PAGE}") and value.endswith(">")):
        raise WarcError(f"unknown record id {value[:80]}")
    number = value[len(PAGE) + 1 : -1]
    return int(number) if number else None


def _length(fields: dict[str, str]) -> int:
    value = fields.get("content-length", "")
    if not value.isdigit():
        raise WarcError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def parse_record(record: bytes) -> tuple:
    """A row of ``RECORD``; raises WarcError unless headers, lengths and digests agree."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in (b"WARC/1.0", b"WARC/1.1"):
        raise WarcError(f"no WARC header: {record[:40]!r}")
    fields = _fields(lines)
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest"} - fields.keys()
    if missing:
        raise WarcError(f"header lacks {sorted(missing)}")
    length = _length(fields)
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"block has {len(rest) - 4} bytes, Content-Length is {length}")
    block = rest[:length]
    if fields.get("warc-block-digest", f"sha1:{digest_of(block)}") != f"sha1:{digest_of(block)}":
        raise WarcError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    size = _length(_fields(http.split(b"\r\n")[1:]))
    algorithm, _, digest = fields["warc-payload-digest"].partition(":")
    kind, refers = fields["warc-type"], fields.get("warc-refers-to")
    if algorithm != "sha1" or not gap:
        raise WarcError("no sha1 payload digest or no HTTP header")
    if kind == "response":
        if len(payload) != size or digest_of(payload) != digest:
            raise WarcError("payload differs from its declared length or digest")
    elif kind == "revisit":
        if payload or refers is None:
            raise WarcError("a revisit needs WARC-Refers-To and has no payload")
    else:
        raise WarcError(f"unknown record type {kind}")
    url = fields.get("warc-target-uri")
    if url is not None and ESCAPED.lower() in fields:
        url = unquote(url)
    return (_page(fields["warc-record-id"]), url, size, digest, kind, _page(refers) if refers else None, payload if kind == "response" else None)


def _reader(with_payload: bool):
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, expected in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                files, path = open_folder(uri.rpartition("/")[0])
                seen, size, rows = 0, 0, []
                with files.open_input_stream(f"{path}/{uri.rpartition('/')[2]}") as stream:
                    for record in records_of(stream):
                        row = parse_record(record)
                        rows.append(row if with_payload else (*row[:-1], None))
                        seen, size = seen + 1, size + (len(record) if with_payload else 200)
                        if size > 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if seen != expected:
                    raise WarcError(f"{uri} has {seen} records, the manifest says {expected}")
                yield batch_of(rows)

    return read


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives in ``manifest``; one task reads one archive at a time."""
    parts = max(1, manifest.count())
    return manifest.repartition(parts).mapInArrow(_reader(with_payload), RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in a new shared folder and read back, without payloads."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), with_payload=False).drop("payload")
