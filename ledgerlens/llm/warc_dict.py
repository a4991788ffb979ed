"""Web archives compressed record by record with an embedded dictionary.

Every archive is a ``.warc.zst`` file: a leading skippable frame (magic 184D2A5D)
holds a Zstandard dictionary built from records of that archive, and each WARC
record is one frame compressed with it, so a reader can begin at any record.
Equal payloads of MIN_REVISIT bytes or more are stored once: the page with the
smallest id is a response, the others are revisits that refer to it.

Tasks write their archives to the shared folder under names of their own, so a
repeated attempt harms nothing; the written list of finished archives says which
count. Texts are only shuffled if the table of repeated digests is too large for
Spark to send around. A task holds one archive (ARCHIVE_BYTES) at a time. The
dictionary is trained on up to SAMPLE_BYTES of evenly spaced records; if they are too
few to train on, they are the dictionary themselves.

Nulls: null html is an empty payload, a null url an empty one. A null page_id is
never referred to: such a page is a revisit if another page with an id has its
payload, else a response. Pages that repeat an id and payload are all responses if that id
is the smallest. An empty table gives no archives.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import shared

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES, DICT_BYTES = 1 << 20, 64 << 10
LEVEL = 3
#: The format's magic numbers and the revisit profile.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

FILES = "file string, records long, raw_bytes long, stored_bytes long, dict_bytes long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def record_id(page_id: int | None) -> str:
    return f"<urn:warc-page:{'none' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    name = record.strip("<>").rpartition(":")[2]
    return None if name == "none" else int(name)


def record_bytes(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None,
                 date: str = DATE) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, which has the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    url = "".join(c for c in url if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}", f"WARC-Target-URI: {url}",
             f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def dictionary_for(records: list[bytes], size: int = DICT_BYTES, sample: int = SAMPLE_BYTES) -> bytes:
    """A dictionary from evenly spaced records of up to ``sample`` bytes."""
    total = sum(map(len, records))
    every = max(1, -(-total // sample))
    picked, used = [], 0
    for r in records[::every]:
        if used + len(r) <= sample:
            picked.append(r)
            used += len(r)
    if not picked:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(256, used // 8)), picked).as_bytes()
    except zstandard.ZstdError:
        return b"".join(picked)[-size:]


def archive_bytes(records: list[bytes], level: int = LEVEL) -> tuple[bytes, int]:
    """The whole archive, and its dictionary's size."""
    content = dictionary_for(records)
    known = zstandard.ZstdCompressionDict(content) if content else None
    writer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(content)), content,
                     *(writer.compress(r) for r in records)]), len(content)


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, from a file-like object, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    content = stream.read(size)
    known = zstandard.ZstdCompressionDict(content) if content else None
    plain = zstandard.ZstdDecompressor(dict_data=known).stream_reader(stream, read_across_frames=True)
    held = b""

    def more() -> bool:
        nonlocal held
        part = plain.read(1 << 18)
        held += part
        return bool(part)

    while True:
        while b"\r\n\r\n" not in held and more():
            pass
        if not held:
            return
        head, _, held = held.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        headers = dict(x.split(": ", 1) for x in lines)
        length = int(headers["Content-Length"]) + 4
        if len(held) < length:
            parts = [held]
            need = length - len(held)
            while need > 0 and (part := plain.read(max(need, 1 << 18))):
                parts.append(part)
                need -= len(part)
            held = b"".join(parts)
        if held[length - 4:length] != b"\r\n\r\n":
            raise ValueError("a WARC record is cut short")
        yield headers, held[:length - 4]
        held = held[length:]


def decide(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """pages (page_id, url, html) -> payload, its digest, and which page it refers to."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.filter(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    firsts = shared.written(firsts.select("digest", "first"), "repeated-digests")
    out = rows.join(firsts, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"))


def write_archives(decided: DataFrame, folder: str, archive: int = ARCHIVE_BYTES,
                   level: int = LEVEL) -> DataFrame:
    """Writes archives of about ``archive`` bytes of records; one row per archive."""

    def write(batches):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        records, raw = [], 0

        def close():
            nonlocal records, raw
            data, dict_bytes = archive_bytes(records, level)
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(f"{path}/{name}", compression=None) as f:
                f.write(data)
            row = [[f"{folder}/{name}"], [len(records)], [raw], [len(data)], [dict_bytes]]
            records, raw = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v) for v in row], names=["file", "records", "raw_bytes", "stored_bytes", "dict_bytes"])

        for batch in batches:
            for row in zip(*batch.columns):
                one = record_bytes(*(x.as_py() for x in row))
                records.append(one)
                raw += len(one)
                if raw >= archive:
                    yield close()
        if records:
            yield close()

    rows = decided.select("page_id", "url", "payload", "digest", "refers_to")
    return shared.written(rows.mapInArrow(write, FILES), "archives")


def read_archives(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """Records of the archives listed in ``files``, digests and lengths from the payloads
    themselves (for revisits: as their heads give them)."""

    def read(batches):
        import hashlib
        for batch in batches:
            for file in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(file)
                rows = []
                with store.open_input_stream(path, compression=None) as f:
                    for headers, block in read_archive(f):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        kind, refers = headers["WARC-Type"], None
                        if kind == "response":
                            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
                            if headers["WARC-Payload-Digest"] != f"sha256:{digest}":
                                raise ValueError(f"{file}: a payload doesn't match its digest")
                        else:
                            size = int(head.decode().rpartition("Content-Length: ")[2])
                            digest = headers["WARC-Payload-Digest"].partition(":")[2]
                            refers = page_of(headers["WARC-Refers-To"])
                        rows.append((page_of(headers["WARC-Record-ID"]), size, digest, kind, refers,
                                     headers["WARC-Target-URI"]))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                    names=[x.split()[0] for x in RECORDS.split(", ")])

    rows = files.select("file")
    return rows.repartition(tasks or max(1, files.count())).mapInArrow(read, RECORDS)


def op8_warc_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared.new_path(spark, "warc")
    files = write_archives(decide(shared.table(spark, sf_dir, "pages")), folder)
    return read_archives(files).drop("url")


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
      FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
