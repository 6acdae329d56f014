"""WARC archives of pages: a writer and a reader of Zstandard-compressed archives with a dictionary.

An archive begins with a skippable frame that holds the dictionary; each
record is one frame. Archives are written by Spark tasks into a shared
folder under names that depend on the partition alone, each put in place by
a rename, so a repeated task replaces its own files. The reader decodes one
frame per record and checks the frame's length, the WARC and HTTP headers,
the block's length and the payload's digest; a mismatch raises ValueError.

Defined results: a null html is an empty payload; a null url has no target
header; urls are percent-encoded in the archive and come back as they were; a
null page_id is read back as null and is never referred to unless
all pages of its payload have none; repeated rows are records of their own,
and those that share the smallest page_id of a payload are all responses;
page_ids are whole numbers or texts (``id_type`` of the reader), anything else is
refused; an empty table makes no archive; a payload of any length is one record,
which a task holds whole; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.llm.scratch import shared_folder

# Fixed values of the formats
SKIPPABLE = 0x184D2A5D
FRAME = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
ARCHIVE_BYTES = 64 << 20
_SAMPLE_BYTES = 1 << 20
_DICTIONARY_BYTES = 32 << 10


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record of the page ``refers_to`` (its block has the HTTP header only)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        headers.append(f"X-Page-Id: {quote(str(page_id), safe='')}")
    if url is not None:
        headers.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=~' + chr(39))}")
    if refers_to is not None:
        headers += [f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page-Id: {quote(str(refers_to), safe='')}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(_DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:  # too few or too short samples
        return zstandard.ZstdCompressionDict(b"".join(samples)[:_DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archives(records: Iterator[bytes], most: int = ARCHIVE_BYTES) -> Iterator[Iterator[bytes]]:
    """Archives of about ``most`` bytes of records, each an iterator over its frames."""
    ahead: list[bytes] = []
    ended = False

    def fill(limit: int) -> None:
        nonlocal ended
        size = sum(map(len, ahead))
        while size < limit and not ended:
            if (r := next(records, None)) is None:
                ended = True
            else:
                ahead.append(r)
                size += len(r)

    def one() -> Iterator[bytes]:
        dictionary = _dictionary(list(ahead))
        data = dictionary.as_bytes()
        yield struct.pack("<II", SKIPPABLE, len(data)) + data
        compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True, write_checksum=True)
        done = 0
        while done < most:
            fill(1)
            if not ahead:
                return
            r = ahead.pop(0)
            done += len(r)
            yield compressor.compress(r)

    while True:
        fill(_SAMPLE_BYTES)
        if not ahead:
            return
        yield one()


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its block headers."""
    flags = data[at + 4]
    at_block = at + zstandard.frame_header_size(bytes(data[at : at + 18]))
    last = False
    while not last:
        head = int.from_bytes(data[at_block : at_block + 3], "little")
        last, kind, size = bool(head & 1), (head >> 1) & 3, head >> 3
        if kind == 3 or at_block + 3 > len(data):
            raise ValueError("a Zstandard block is damaged")
        at_block += 3 + (1 if kind == 1 else size)
    return at_block + (4 if flags & 4 else 0)


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    view = memoryview(data)
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    at = 8 + struct.unpack_from("<I", data, 4)[0]
    stored = data[8:at]
    if stored[:4] == struct.pack("<I", FRAME):
        stored = zstandard.ZstdDecompressor().decompress(stored)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stored))
    while at < len(data):
        end = frame_end(view, at)
        frame = bytes(view[at:end])
        said = zstandard.frame_content_size(frame)
        out = decompressor.decompress(frame)
        if end > len(data) or (said >= 0 and said != len(out)):
            raise ValueError("a frame's length is wrong")
        yield out
        at = end


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in lines.split(b"\r\n")[1:])
    return {k.decode().lower(): v.strip().decode() for k, _, v in pairs}


def parse(data: bytes) -> dict:
    """A record's headers (``warc``, ``http``) and ``payload``, all checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"WARC/1."):
        raise ValueError("a record has no WARC header")
    warc = _headers(head)
    block = rest[: int(warc["content-length"])]
    if len(rest) != len(block) + 4 or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a block's length is wrong")
    http_head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http_head.startswith(b"HTTP/1."):
        raise ValueError("a block has no HTTP header")
    http = _headers(http_head)
    if warc["warc-type"] == "response" and (len(payload) != int(http["content-length"]) or f"sha1:{sha1_base32(payload)}" != warc["warc-payload-digest"]):
        raise ValueError("a payload doesn't match its headers")
    return {"warc": warc, "http": http, "payload": payload}


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """The pages with ``_first``: the smallest page_id of the payload, where another page has it too."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.withColumn("_sha1", F.when(F.octet_length(payload) >= least, F.sha1(payload)))
    first = keyed.where("_sha1 is not null").groupBy("_sha1").agg(F.min("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return keyed.join(first, "_sha1", "left").drop("_sha1")


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> int:
    """Write every page as a record; the number of records. ``folder`` is a URI that all tasks can reach."""
    if (kind := dict(pages.dtypes)["page_id"]) not in ("tinyint", "smallint", "int", "bigint", "string"):
        raise ValueError(f"page_id is {kind}; archives tell pages by whole numbers or texts")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        count = 0

        def records() -> Iterator[bytes]:
            nonlocal count
            for batch in batches:
                for page_id, url, html, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "_first")), strict=True):
                    count += 1
                    own, other = page_id.as_py(), first.as_py()
                    yield record(own, url.as_py(), (html.as_py() or "").encode(), None if other is None or other == own else other)

        for k, frames in enumerate(archives(records(), archive_bytes)):
            name = posixpath.join(base, f"part-{task.partitionId():06d}-{k:04d}.warc.zst")
            draft = f"{name}.{task.taskAttemptId()}.draft"
            with store.open_output_stream(draft) as out:
                for frame in frames:
                    out.write(frame)
            store.move(draft, name)
        yield pa.RecordBatch.from_pydict({"n": [count]})

    # in order within a partition, so that a repeated task makes the same files
    ready = with_revisits(pages.select("page_id", "url", "html"), least).sortWithinPartitions("page_id", "url", F.xxhash64("html"))
    return ready.mapInArrow(go, "n long").agg(F.sum("n")).first()[0] or 0


def read_archives(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for a revisit). ``id_type``: long or string."""
    schema = f"page_id {id_type}, url string, record_type string, payload_bytes long, payload_digest string, refers_to {id_type}, payload binary"
    texts = id_type == "string"
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    own = pa.string() if texts else pa.int64()
    kinds = [own, pa.string(), pa.string(), pa.int64(), pa.string(), own, pa.binary()]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for data in records_of(content.as_py()):
                    r = parse(data)
                    warc, kind = r["warc"], r["warc"]["warc-type"]
                    given = lambda k: unquote(warc[k]) if k in warc else None  # noqa: E731, B023
                    page_id, refers_to = (x if texts or x is None else int(x) for x in map(given, ("x-page-id", "x-refers-to-page-id")))
                    rows.append((page_id, given("warc-target-uri"), kind, int(r["http"]["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:"), refers_to, r["payload"] if kind == "response" else None))
                    size += len(data)
                    if size > 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
                if rows:
                    yield flush(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select("content").mapInArrow(go, schema)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = f"{shared_folder(spark)}/acreage/warc-{uuid.uuid4().hex}"
    if not write_archives(pages, folder):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = r"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
f as (select *, min(page_id) over (partition by h) as first from p)
select page_id, strlen(html)::bigint as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, ((i // 8) * 10 + 1)::int, 10))::ubigint >> (35 - 5 * (i % 8))::ubigint) & 31::ubigint) + 1)::int, 1)), '') as payload_digest,
       case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from f
"""
