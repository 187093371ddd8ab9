"""WARC archives in Zstandard: a shared dictionary in a leading skippable frame, then one frame per record.

Archives are byte strings of bounded size, kept in a Parquet table so that Spark commits and retries them; the reader
takes any (name, content) rows, also those of Spark's binaryFile source over .warc.zst files.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import query, table
from tickloom.session import shared_root

#: Fixed values of the formats.
SKIPPABLE, FRAME, DATE = 0x184D2A5D, 0xFD2FB528, "2020-01-01T00:00:00Z"
#: Payload bytes after which an archive is closed; pages its dictionary is trained on, and the dictionary's size.
ARCHIVE_BYTES, SAMPLE_PAGES, DICTIONARY_BYTES = 8 << 20, 200, 16 << 10
#: Payloads below this size are never revisits.
LEAST_BYTES = 100

RECORDS = ("archive string, record_id string, record_type string, target string, payload_bytes long, payload_digest string, "
           "refers_to string, payload binary, error string")


def record(kind: str, name: str, target: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, with the full length, and no payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{refers_to}>"]
    return ("\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def archive(records: list[bytes]) -> bytes:
    """The records as an archive; too few or too short ones for a dictionary get an empty one."""
    import zstandard
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records[:SAMPLE_PAGES]).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    with_ = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    packer = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True, **with_)
    return b"".join([struct.pack("<II", SKIPPABLE, len(trained)), trained, *map(packer.compress, records)])


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and block headers; raises ValueError if cut short."""
    if len(data) < at + 5 or struct.unpack_from("<I", data, at)[0] != FRAME:
        raise ValueError("no frame")
    flags = data[at + 4]
    single, sizes = flags >> 5 & 1, (0, 2, 4, 8)
    at += 5 + (not single) + (0, 1, 2, 4)[flags & 3] + (sizes[flags >> 6] or single)
    while True:
        if at + 3 > len(data):
            raise ValueError("frame cut short")
        head = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            at += 4 * (flags >> 2 & 1)
            if at > len(data):
                raise ValueError("frame cut short")
            return at


def parse(content: bytes) -> dict:
    """A record's fields; ValueError says what is wrong with its version, headers, lengths or digest."""
    head, blank, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8").split("\r\n")
    if not blank or not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header without a colon: {line[:40]}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "content-length"):
        if name not in fields:
            raise ValueError(f"no {name}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("wrong content-length")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    sizes = [line.partition(":")[2].strip() for line in http.decode("utf-8").split("\r\n") if line.lower().startswith("content-length:")]
    if not blank or len(sizes) != 1 or not sizes[0].isdigit():
        raise ValueError("no HTTP length")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = fields["warc-type"]
    if kind == "response" and (len(payload) != int(sizes[0]) or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("revisit with a payload or without a target")
    return {"record_id": fields["warc-record-id"].strip("<>"), "record_type": kind, "target": fields.get("warc-target-uri"),
            "payload_bytes": int(sizes[0]), "payload_digest": digest, "payload": payload if kind == "response" else None,
            "refers_to": fields["warc-refers-to"].strip("<>") if kind == "revisit" else None, "error": None}


def records_of(content: bytes):
    """The records of one archive in turn. A bad record is an error row; a bad frame ends the archive with one."""
    import zstandard
    data, at, with_ = memoryview(content), 0, {}
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", data, 4)[0]
        if size:
            loaded = bytes(data[8:8 + size])
            if len(loaded) != size:
                yield {"error": "dictionary cut short"}
                return
            # A dictionary may itself be one Zstandard frame.
            if loaded[:4] == struct.pack("<I", FRAME):
                loaded = zstandard.ZstdDecompressor().decompress(loaded)
            with_["dict_data"] = zstandard.ZstdCompressionDict(loaded)
        at = 8 + size
    unpacker = zstandard.ZstdDecompressor(**with_)
    while at < len(data):
        try:
            end = frame_end(data, at)
            opened = unpacker.decompressobj()
            content_ = opened.decompress(data[at:end])
            if not opened.eof:
                raise ValueError("frame not whole")
        except (ValueError, zstandard.ZstdError) as wrong:
            yield {"error": f"frame at {at}: {wrong}"}
            return
        try:
            yield parse(content_)
        except ValueError as wrong:
            yield {"error": str(wrong)}
        at = end


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per row of ``pages`` (page_id, url, html), as a folder of (archive, content) rows at ``path``.

    Of equal payloads of at least 100 bytes the one of the smallest page_id is a response and the others revisit it;
    rows that tie for the smallest are all responses, and so is a payload none of whose pages has an id. A null html is
    an empty payload, a null url an empty target. Equal payloads are found by their digests with partial minima, so no
    group of copies is ever gathered.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), payload.alias("payload"),
                        F.sha2(payload, 256).alias("digest"))
    firsts = rows.where(F.length("payload") >= LEAST_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.max("page_id").alias("last"), F.count_if(F.col("page_id").isNull()).alias("lost"))
    firsts = firsts.where("first < last or (first is not null and lost > 0)").select("digest", "first")
    rows = rows.join(firsts.hint("shuffle_hash"), "digest", "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))

    def run(batches):
        name = f"part-{TaskContext.get().partitionId():05d}"
        held, size, number = [], 0, 0
        for batch in batches:
            for page, url, body, digest, refers in zip(*(batch.column(i) for i in range(5))):
                body, refers = body.as_py(), refers.as_py()
                held.append(record("response" if refers is None else "revisit", f"urn:page:{'' if page.as_py() is None else page.as_py()}",
                                   (url.as_py() or "").replace("\r", "%0D").replace("\n", "%0A"), body, digest.as_py(),
                                   None if refers is None else f"urn:page:{refers}"))
                size += len(body)
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_pydict({"archive": [f"{name}-{number:05d}.warc.zst"], "content": [archive(held)]}, schema)
                    held, size, number = [], 0, number + 1
        if held:
            yield pa.RecordBatch.from_pydict({"archive": [f"{name}-{number:05d}.warc.zst"], "content": [archive(held)]}, schema)

    schema = pa.schema([("archive", pa.string()), ("content", pa.binary())])
    rows.mapInArrow(run, "archive string, content binary").write.parquet(path)


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of (archive, content) rows; records that fail a check have an error and nothing else.

    Null and empty contents hold no records. Without ``payloads`` the column stays null, though each is checked.
    """
    names = ["record_id", "record_type", "target", "payload_bytes", "payload_digest", "refers_to", "payload", "error"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("archive"), batch.column("content")):
                held, size = [], 0
                for row in records_of(content.as_py() or b""):
                    if not payloads:
                        row["payload"] = None
                    held.append(row)
                    size += len(row.get("payload") or b"") + 200
                    if size > 4 << 20:
                        yield batch_of(name.as_py(), held)
                        held, size = [], 0
                if held:
                    yield batch_of(name.as_py(), held)

    def batch_of(name, rows):
        return pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), *(pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds))],
                                          ["archive", *names])

    return archives.select("archive", "content").mapInArrow(run, RECORDS)


_ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.h AS payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.h = f.h AND n >= 100
"""


@query("op8_warc_archives", _ORACLE)
def _archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_root(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    rows = read_archives(spark.read.parquet(path), payloads=False)
    number = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("")).cast("long")
    checked = F.when(F.col("error").isNull(), number("record_id")).otherwise(F.raise_error(F.col("error")).cast("long"))
    return rows.select(checked.alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
