"""WARC archives compressed record by record with an embedded dictionary.

Each task gathers records up to ``ARCHIVE_BYTES``, builds a Zstandard dictionary
from them, and writes one archive: a skippable frame (magic 0x184D2A5D) that
holds the compressed dictionary, then one Zstandard frame per record.  Archives
have names of their own for every attempt of a task; only those in the manifest
that committed tasks return are read, so a lost executor costs a rewrite.

Of records with equal payloads the one with the largest page_id is the
response; the others are revisits that refer to it and hold no payload.

Defined results: a null html counts as empty; a null url is about:blank; a null
page_id is the smallest of all (such a record is a response only if its group has
no other id) and reads back as null; rows that repeat the response's id are
responses too; an empty table gives no archive and an empty result; further
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trellis.plans.tables import stored
from trellis.session import delete_dir, shared_dir
from trellis.sources.tables import read_table

#: Magic number of the skippable frame that holds the dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
#: Samples of up to so many bytes, evenly spread over the archive's records.
SAMPLE_BYTES = 4 << 20
LEVEL = 3
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_READ = 1 << 16


def record_id(page_id: int | None, digest: str, url: str) -> str:
    """A URN that holds the page id (an RFC 9562 version 8 UUID), or that
    digest and url decide where there is none."""
    if page_id is None:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest + ' ' + url)}>"
    raw = (page_id & (1 << 64) - 1).to_bytes(8, "big")
    return f"<urn:uuid:{uuid.UUID(bytes=b'pageid' + bytes([0x80, raw[0], 0x80]) + raw[1:])}>"


def page_of(urn: str) -> int | None:
    raw = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).bytes
    if not raw.startswith(b"pageid") or raw[6] != 0x80 or raw[8] != 0x80:
        return None
    return int.from_bytes(raw[7:8] + raw[9:], "big", signed=True)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; ``refers_to`` makes it a revisit."""
    uri = urllib.parse.quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "about:blank"
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest, uri)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest, uri)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, HTTP headers and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    length = int(headers["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return {"headers": headers, "http": http, "payload": payload}


def train(records: list[bytes]):
    """A dictionary for the records, or None where there is too little to learn."""
    import zstandard
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 8)), records[::step], k=1024, d=8)
    except zstandard.ZstdError:
        return None


def write_archive(records: list[bytes], out) -> None:
    """Dictionary frame (where one could be built), then a frame per record."""
    import zstandard
    dictionary = train(records)
    if dictionary is not None:
        body = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
        out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
    for r in records:
        out.write(packer.compress(r))


def read_archive(source):
    """Yield the records of an archive from a binary stream, frame by frame."""
    import zstandard
    data = source.read(_READ)
    dictionary = None
    if data[:4] == DICTIONARY_MAGIC.to_bytes(4, "little"):
        size = int.from_bytes(data[4:8], "little")
        while len(data) < 8 + size and (more := source.read(_READ)):
            data += more
        body, data = data[8:8 + size], data[8 + size:]
        if body[:4] == ZSTD_MAGIC:
            body = zstandard.ZstdDecompressor().decompress(body)
        dictionary = zstandard.ZstdCompressionDict(body)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := source.read(_READ)):
        frame, parts = unpacker.decompressobj(), []
        while True:
            parts.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data
                break
            data = source.read(_READ)
            if not data:
                raise ValueError("archive is cut short")
        yield b"".join(parts)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to (null: a response).  Only digests that
    occur twice or more are joined back, and AQE splits a hot one."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    same = (rows.groupBy("digest").agg(F.max("page_id").alias("chosen"), F.count("*").alias("n"))
            .where("n > 1").select("digest", "chosen"))
    return rows.join(same, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("page_id").eqNullSafe(F.col("chosen")), None).otherwise(F.col("chosen")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows of ``with_revisits`` below ``folder``; the manifest (path,
    records), stored, of the archives that count."""
    def run(batches):
        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)

        def flush(records):
            name = f"{uuid.uuid4().hex}.warc.zst"
            with where.open_output_stream(f"{base}/{name}", compression=None) as out:
                write_archive(records, out)
            return pa.RecordBatch.from_pydict({"path": pa.array([f"{folder.rstrip('/')}/{name}"]),
                                               "records": pa.array([len(records)], pa.int64())})

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                held.append(make_record(*(x.as_py() for x in row)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return stored(rows.mapInArrow(run, "path string, records long"))


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (as the headers say, for responses held against the payload)
    and payload (null for revisits).  Archives are dealt out by path."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                where, name = fs.FileSystem.from_uri(path)
                with where.open_input_stream(name, compression=None) as source:
                    held, size = [], 0
                    for data in read_archive(source):
                        held.append(_row(parse_record(data)))
                        size += len(data)
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=ROW)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema=ROW)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(n, "path").mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string, payload binary")


ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                 ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _row(record: dict) -> dict:
    h = record["headers"]
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(record["http"]["Content-Length"])
    whole = h["WARC-Type"] == "response"
    if whole and (size != len(record["payload"]) or digest != payload_digest(record["payload"])):
        raise ValueError(f"payload of {h['WARC-Record-ID']} does not match its digest")
    return {"page_id": page_of(h["WARC-Record-ID"]), "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"],
            "refers_to": page_of(h["WARC-Refers-To"]) if "WARC-Refers-To" in h else None, "payload_bytes": size,
            "payload_digest": digest, "payload": record["payload"] if whole else None}


def op1_warc(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = shared_dir(spark, "warc")
    manifest = write_archives(with_revisits(pages), folder)
    out = stored(read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    delete_dir(spark, folder)       # the query wants the rows only
    return out
