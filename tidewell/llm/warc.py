"""WARC archives of zstandard frames, written and read back.

An archive begins with a skippable frame that holds a zstandard dictionary,
followed by one frame for each record, compressed with it; a reader can start
at any frame. Each task writes archives of bounded size into the shared
folder's ``attempts``, under a name of its own that ends in the record count,
and its rows name the archives that it finished. Those rows are a written
table; a second step moves the archives that it names to ``done``, and only
those are read, whatever became of attempts that were lost.

Records are WARC/1.1. A response holds an HTTP header and the payload; a
revisit holds the HTTP header alone, names the payload's digest and the record
that it repeats. Reading checks the magic numbers, the dictionary, every
header, the block and payload lengths, the digest and the ends of record and
frame, and raises ``ArchiveError`` where something does not fit.

Of records with equal payloads of at least ``min_revisit`` bytes, that with
the smallest id is the response. Defined results: a null payload is an empty
one; a null id is written without an id, comes after all others and reads
back as null (equal payloads of null ids only are all responses); rows that
share the smallest id are all responses; repeated rows are a record each.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lineage import scratch_path
from .common import as_blocks, pinned

MIN_REVISIT = 100
ARCHIVE_BYTES = 32 << 20
DICT_BYTES = 32768
SAMPLE_BYTES = 1 << 20
SKIPPABLE = b"\x5d\x2a\x4d\x18"
FRAME = b"\x28\xb5\x2f\xfd"
ID = "urn:page:"


class ArchiveError(ValueError):
    """Something in an archive does not fit."""


def marked_revisits(pages: DataFrame, id_col: str, payload_col: str, url_col: str,
                    min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(id, url, payload, digest, refers_to)``; ``refers_to`` is null for responses.

    Only payloads that come more than once are joined, and only their digests and ids are aggregated.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    pages = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                         payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    first = (pages.filter(F.length("payload") >= min_revisit).groupBy("digest")
                  .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    refers = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return pages.join(first, "digest", "left").select("id", "url", "payload", "digest", refers.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: <{ID}{page_id}>")
    if url:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <{ID}{refers_to}>")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def trained(samples: list[bytes]) -> bytes:
    """A dictionary from the first records of an archive, empty where there is too little to train on."""
    parts = [b for s in samples for b in as_blocks(s, 4096)]
    if len(parts) < 16 or sum(map(len, parts)) < 8 * DICT_BYTES:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> Iterator[bytes]:
    """The bytes of an archive: its dictionary's frame, then a frame for each record."""
    sample, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        sample.append(r[:SAMPLE_BYTES])
        size += len(r)
    data = trained(sample)
    yield SKIPPABLE + len(data).to_bytes(4, "little") + data
    loaded = zstandard.ZstdCompressionDict(data) if data else None
    compressor = zstandard.ZstdCompressor(level=3, dict_data=loaded, write_checksum=True)
    for r in records:
        yield compressor.compress(r)


def write_archives(marked: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records of ``marked_revisits``; returns the table ``(name)`` of archives in ``folder/done``."""

    def finished(records: list[bytes]) -> pd.DataFrame:
        fs, base = pyarrow.fs.FileSystem.from_uri(f"{folder}/attempts")
        fs.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}-{len(records)}.warc.zst"
        with fs.open_output_stream(f"{base}/{name}", compression=None) as out:  # frames are compressed already
            for part in archive(records):
                out.write(part)
        return pd.DataFrame({"name": [name]})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records, size = [], 0
        for batch in batches:
            ids, refers = ([None if x is None else int(x) for x in batch[c]] for c in ("id", "refers_to"))
            for i, url, payload, digest, refers_to in zip(ids, batch["url"], batch["payload"], batch["digest"], refers,
                                                         strict=True):
                records.append(record(i, url, payload, digest, refers_to))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield finished(records)
                    records, size = [], 0
        if records:
            yield finished(records)

    def publish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(f"{base}/done", recursive=True)
        for batch in batches:
            for name in batch["name"]:
                there, here = fs.get_file_info([f"{base}/done/{name}", f"{base}/attempts/{name}"])
                if here.type != pyarrow.fs.FileType.NotFound:
                    fs.move(here.path, there.path)
                elif there.type == pyarrow.fs.FileType.NotFound:
                    raise ArchiveError(f"{name} is gone")  # else an earlier attempt of this task has moved it
            yield batch

    exact = marked.withColumns({c: F.col(c).cast("string") for c in ("id", "refers_to")})  # pandas has no null in longs
    written = pinned(exact.mapInPandas(write, "name string"), "archives")
    return pinned(written.mapInPandas(publish, "name string"), "published")


def frames(data: bytes) -> Iterator[bytes]:
    """The decoded records of an archive, one for each frame."""
    view, at = memoryview(data), 0
    loaded = None
    if data[:4] == SKIPPABLE:
        size = int.from_bytes(data[4:8], "little")
        at = 8 + size
        if at > len(data):
            raise ArchiveError("the dictionary's frame is cut off")
        if size:
            loaded = zstandard.ZstdCompressionDict(data[8:at], dict_type=zstandard.DICT_TYPE_FULLDICT)
    decompressor = zstandard.ZstdDecompressor(dict_data=loaded)
    while at < len(data):
        if data[at:at + 4] != FRAME:
            raise ArchiveError(f"no frame at byte {at}")
        size = zstandard.frame_content_size(data[at:at + 18])
        one, parts = decompressor.decompressobj(), []
        try:
            while not one.eof:
                if at >= len(data):
                    raise ArchiveError("the last frame is cut off")
                piece = view[at:at + 65536]
                parts.append(one.decompress(piece))
                at += len(piece) - len(one.unused_data)
        except zstandard.ZstdError as e:
            raise ArchiveError(f"a frame can't be decoded: {e}") from e
        out = b"".join(parts)
        if size >= 0 and size != len(out):
            raise ArchiveError(f"a frame of {size} bytes decodes to {len(out)}")
        yield out


def headers(raw: bytes, first: str) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith(first):
        raise ArchiveError(f"{first} expected, not {lines[0][:40]!r}")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(": ")
        if not colon:
            raise ArchiveError(f"not a header: {line[:40]!r}")
        found[name.lower()] = value
    return found


def _number(found: dict[str, str], name: str) -> int:
    if not found.get(name, "").isdigit():
        raise ArchiveError(f"{name} is missing or no number")
    return int(found[name])


def _page(value: str | None) -> int | None:
    if value is None:
        return None
    if not value.startswith(f"<{ID}") or not value.endswith(">"):
        raise ArchiveError(f"not a page id: {value[:40]!r}")
    return int(value[len(ID) + 1:-1])


def parsed(raw: bytes) -> dict:
    """A record's id, type, payload and references, with every length and digest checked."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    found = headers(head, "WARC/1.1")
    n = _number(found, "content-length")
    if not blank or rest[n:] != b"\r\n\r\n":
        raise ArchiveError("the block's length differs from its header")
    http, blank, payload = rest[:n].partition(b"\r\n\r\n")
    size = _number(headers(http, "HTTP/1.1 200"), "content-length")
    algorithm, _, digest = found.get("warc-payload-digest", "").partition(":")
    kind, refers = found.get("warc-type"), _page(found.get("warc-refers-to"))
    if not blank or algorithm != "sha256" or kind not in ("response", "revisit"):
        raise ArchiveError("a header is missing or unknown")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ArchiveError("the payload differs from its length or digest")
    if (kind == "revisit") != (refers is not None) or kind == "revisit" and payload:
        raise ArchiveError("a revisit without a reference or with a payload, or a response with a reference")
    return {"id": _page(found.get("warc-page-id")), "url": found.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": refers,
            "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of a folder's archives, checked against the counts in their names."""
    columns = ["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
    schema = ("id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
              + ", payload binary" * payloads)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                n, rows, size = 0, [], 0
                for raw in frames(data):
                    row = parsed(raw)
                    row |= {c: None if row[c] is None else str(row[c]) for c in ("id", "refers_to")}
                    rows.append(row)
                    n, size = n + 1, size + len(raw)
                    if size >= 8 << 20:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
                if n != int(path.rpartition("-")[2].partition(".")[0]):
                    raise ArchiveError(f"{path} has {n} records")
                yield pd.DataFrame(rows, columns=columns)

    # a task reads as many archives as fit a split (spark.sql.files.maxPartitionBytes), so batches stay bounded
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInPandas(read, schema).withColumns({c: F.col(c).cast("long") for c in ("id", "refers_to")})


def archive_pages(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url",
                  min_revisit: int = MIN_REVISIT, payloads: bool = True) -> DataFrame:
    """Writes a record for each page to archives in the shared folder and reads them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    written = write_archives(marked_revisits(pages, id_col, payload_col, url_col, min_revisit), folder)
    if written.isEmpty():
        empty = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
        back = spark.createDataFrame([], empty + ", payload binary" * payloads)
    else:
        back = read_archives(spark, f"{folder}/done", payloads)
    return back.withColumnRenamed("id", id_col).withColumnRenamed("payload", payload_col)
