"""WARC archives in Zstandard form: one frame per record, the dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcflow.llm.common import small
from cdcflow.session import materialize

#: Magic numbers and marks of the formats (fixed values).
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An empty skippable frame.  Its bytes are ASCII, so Spark's text writer can put it between rows.
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")
#: Records of one archive file, its dictionary and its warcinfo record included.
FILE_RECORDS = 1000
#: The dictionary is made from at most this many payloads of at most so many bytes, chosen by hash.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 500, 32_768, 65_536
#: Groups of equal payloads that may be broadcast to the pages; beyond, the same join shuffles.
BROADCAST_GROUPS = 200_000
_FEED = 1 << 14

RECORDS = (
    "file string, offset bigint, record_type string, record_id string, page_id bigint, url string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary, problem string"
)


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (UTF-8, null: empty), payload_bytes, payload_digest."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    return rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})


def deduplicated(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Adds refers_to: the largest page_id among equal payloads of ``least_bytes`` or more, null for that page itself.

    Equal means equal SHA-256 and length.  Groups are found map-side first; only groups of two or more
    are joined back.  Pages without id refer to no one and are referred to by none.
    """
    rows = payloads(pages).withColumn("_key", F.when(F.col("payload_bytes") >= least_bytes, F.sha2("payload", 256)))
    groups = rows.where("_key is not null and page_id is not null").groupBy("_key", "payload_bytes").agg(F.max("page_id").alias("_last"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1").drop("n"), "payload-groups")
    joined = rows.join(small(groups, BROADCAST_GROUPS), ["_key", "payload_bytes"], "left")
    return joined.withColumn("refers_to", F.when(F.col("page_id") < F.col("_last"), F.col("_last"))).drop("_key", "_last")


def make_dictionary(pages: DataFrame) -> bytes:
    """A compression dictionary from a bounded sample; empty if there is nothing to learn from.

    Rows are thinned by a hash to about four times the sample before the smallest hashes are taken, so
    what tasks send to the driver does not grow with their number.
    """
    rows = payloads(pages).where(F.col("payload_bytes").between(1, SAMPLE_BYTES)).withColumn("_code", F.xxhash64("page_id", "url", "payload"))
    share = min(1.0, 4 * SAMPLE_PAGES / max(pages.count(), 1))
    thin = rows.where(F.pmod("_code", F.lit(1 << 30)) < int(share * (1 << 30)))
    samples = [bytes(r["payload"]) for r in thin.orderBy("_code", "page_id").limit(SAMPLE_PAGES).select("payload").collect()]
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes, date: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def _page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url or "")),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to is None:
        return _record("response", f"urn:page:{'' if page_id is None else page_id}", headers, http + payload, date)
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    return _record("revisit", f"urn:page:{page_id}", headers, http, date)


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 1000) -> None:
    """One record per page, in files of at most ``FILE_RECORDS`` records under ``folder``.

    Each file is a sequence of Zstandard frames: a skippable one with the dictionary, a warcinfo record,
    then one frame per page.  Spark's own text writer stores the frames as rows, with an empty
    skippable frame as the line end, so files appear by Spark's commit on any file system and
    a lost task leaves nothing behind.
    """
    dictionary = make_dictionary(pages)
    lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstd.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstd.ZstdCompressor(level=6, dict_data=shared, write_checksum=True).compress
        info = pack(_record("warcinfo", "urn:archive:pages", [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", date))
        made = 0
        for batch in batches:
            rows, held = zip(*batch.to_pydict().values(), strict=True), 0
            out: list[bytes] = []
            for page_id, url, payload, digest, refers_to in rows:
                if made % FILE_RECORDS == 0:
                    out += [lead, info]
                    made += 2
                out.append(pack(_page_record(page_id, url, payload, digest, refers_to, date)))
                made += 1
                held += len(out[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    rows = deduplicated(pages, least_bytes).select("page_id", "url", "payload", "payload_digest", "refers_to")
    made = rows.mapInArrow(frames, "frame binary").select(F.col("frame").cast("string").alias("value"))
    made.write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def read_frames(data: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, record, problem) of each Zstandard frame of an archive; skippable frames are passed over.

    The dictionary is the content of a skippable frame at the very start, itself compressed or not.
    Damage ends the archive with one row that names it.
    """
    at, unpack = 0, zstd.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if at + 8 <= len(data) else (0, 0)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            if at + 8 + size > len(data):
                yield at, None, "skippable frame cut off"
                return
            if at == 0 and magic == DICTIONARY_MAGIC and size:
                content = data[8 : 8 + size]
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = zstd.ZstdDecompressor().decompressobj().decompress(content)
                unpack = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(content))
            at += 8 + size
            continue
        stream, out, fed = unpack.decompressobj(), [], at
        try:
            while not stream.eof and fed < len(data):
                out.append(stream.decompress(data[fed : fed + _FEED]))
                fed = min(fed + _FEED, len(data))
        except zstd.ZstdError as e:
            yield at, None, f"frame does not decode: {e}"
            return
        if not stream.eof:
            yield at, None, "frame cut off"
            return
        yield at, b"".join(out), None
        at = fed - len(stream.unused_data)


def read_record(raw: bytes) -> dict:
    """The fields of ``RECORDS`` of one record; ``problem`` names the first check that fails."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    row = {"record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id", "").strip("<>") or None, "url": headers.get("warc-target-uri")}
    if not re.fullmatch(r"WARC/1\.[01]", lines[0]):
        return row | {"problem": "no WARC version line"}
    if missing := [k for k in ("warc-type", "warc-record-id", "warc-date", "content-length") if not headers.get(k)]:
        return row | {"problem": f"no {missing[0]}"}
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return row | {"problem": "content-length differs from the block"}
    if row["record_type"] not in ("response", "revisit"):
        return row
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    stated = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)
    digest = headers.get("warc-payload-digest", "")
    if not mark or not http.startswith(b"HTTP/1.1 ") or not stated:
        return row | {"problem": "no HTTP header"}
    try:
        row["payload_digest"] = base64.b32decode(digest.removeprefix("sha1:")).hex()
    except ValueError:
        return row | {"problem": "payload digest is not SHA-1 in base32"}
    row |= {"payload_bytes": int(stated[1]), "page_id": _page(row["record_id"]), "refers_to": _page(headers.get("warc-refers-to", "").strip("<>"))}
    if row["record_type"] == "revisit":
        return row | {"problem": None if row["refers_to"] is not None and not payload else "revisit without target or with a payload"}
    if len(payload) != row["payload_bytes"]:
        return row | {"problem": "HTTP content-length differs from the payload"}
    if hashlib.sha1(payload).hexdigest() != row["payload_digest"]:
        return row | {"problem": "payload digest differs"}
    return row | {"payload": payload}


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"urn:page:(-?[0-9]+)", name or "")
    return int(found[1]) if found else None


def read_archives(spark, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of all archives below ``folder``, see ``RECORDS``; archives are read whole, one row of a file each.

    The writer bounds a file's size.  Damaged records and archives come out as rows with a ``problem``.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = {"offset": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for offset, raw, problem in read_frames(data.as_py()):
                    row = {"problem": problem} if raw is None else read_record(raw)
                    if not with_payload:
                        row.pop("payload", None)
                    rows.append(row | {"file": path, "offset": offset})
                    held += len(row.get("payload", b""))
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    return files.select("path", "content").mapInArrow(records, RECORDS)


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Writes archives and returns the page records as read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null payloads are empty ones; null URLs are empty; a null id is written as none and comes back null,
    always a response; rows that repeat an id each get a record, and all rows with the largest id
    of equal payloads are responses.  Extra columns are not read; an empty table gives no rows.  A
    record or archive that does not pass the reader's checks fails the query.
    """
    write_archives(pages, folder)
    rows = read_archives(pages.sparkSession, folder, with_payload=False)
    checked = F.when(F.col("problem").isNotNull(), F.raise_error(F.concat_ws(" ", "file", "offset", "problem")).cast("string")).otherwise(F.col("record_type"))
    rows = rows.withColumn("record_type", checked).where("record_type in ('response', 'revisit')")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
