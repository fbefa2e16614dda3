"""WARC archives through a chunked record table.

Payloads become rows of record, chunk number and bytes, so nothing behind the input column holds a whole record:
archives are written chunk by chunk, digests are carried from chunk to chunk, and reading back streams as well.
Each chunk is a gzip member of its own; members that follow each other are one record, as WARC allows.

Archives lie in the shared folder. A task writes under a name of its own attempt and returns what it wrote; the
manifest of those rows is a table, so leftovers of a lost executor are in no manifest and are never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.keys import named
from stratalake.llm.common import stage
from stratalake.session import fresh_path

CHUNK_BYTES = 1 << 20
READ_BYTES = 1 << 18
#: Chunks that one archive holds, about.
ARCHIVE_CHUNKS = 1 << 14
VERSION = b"WARC/1.1"
EPOCH = b"1970-01-01T00:00:00Z"
RECORD = "urn:page:"


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, first``: the page a revisit refers to, null for a response.

    Payloads of at least ``least_bytes`` are equal when length and SHA-256 are; the smallest id of them is the
    response. Sizes and hashes move, payloads do not: they are read again beside the narrow result.
    """
    own = pages.select(
        named(id_col).cast("long").alias("page_id"),
        F.coalesce(named(url_col).cast("string"), F.lit("")).alias("url"),
        F.coalesce(named(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    hashed = own.withColumn("hash", F.sha2("payload", 256))
    least = hashed.filter(F.octet_length("payload") >= least_bytes).groupBy("hash").agg(F.min("page_id").alias("first"))
    joined = hashed.join(least.filter("first is not null"), "hash", "left")
    # A page without an id cannot be referred to, but it can revisit one that has an id.
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", F.when(revisits, F.col("first")).alias("first"))


def chunks(recs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table: ``page_id, url, first, size, sha1, chunk, of, bytes``, at least one row a record.

    The chunks of a record follow each other in one partition. A revisit is one row without bytes.
    """
    size = F.octet_length("payload").cast("long")
    of = F.when(F.col("first").isNotNull(), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(size / chunk_bytes)).cast("int"))
    flat = recs.withColumns({"size": size, "sha1": F.sha1("payload"), "of": of})
    flat = flat.select("*", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("chunk"))
    piece = F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    held = F.when(F.col("first").isNull(), piece)
    return flat.select("page_id", "url", "first", "size", "sha1", "chunk", "of", held.alias("bytes"))


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _header(page_id: int | None, url: str, first: int | None, digest: str, size: int) -> bytes:
    """Header block of a record. A revisit has no block of its own but tells digest and length of its payload."""
    name = "none-" + uuid.uuid4().hex if page_id is None else str(page_id)
    fields = [
        (b"WARC-Type", b"response" if first is None else b"revisit"),
        (b"WARC-Record-ID", f"<{RECORD}{name}>".encode()),
        (b"WARC-Date", EPOCH),
        (b"WARC-Target-URI", " ".join(url.split()).encode()),
        (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
        (b"WARC-Payload-Length", str(size).encode()),
        (b"Content-Type", b"text/html"),
        (b"Content-Length", str(size if first is None else 0).encode()),
    ]
    if first is not None:
        fields += [
            (b"WARC-Refers-To", f"<{RECORD}{first}>".encode()),
            (b"WARC-Profile", b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    return b"\r\n".join([VERSION, *[k + b": " + v for k, v in fields], b"", b""])


MANIFEST = "archive string, records long"


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` and return the written manifest: ``archive, records``.

    The SHA-1 in a header comes from the record's row; the bytes written are digested chunk by chunk and must
    give the same.
    """
    schema = pa.schema([("archive", pa.string()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _place(folder)
        out, name, count, held, carried = None, "", 0, 0, None
        for b in batches:
            for n in range(b.num_rows):
                page_id, url, first, size, sha1, chunk, of, data = (c[n].as_py() for c in b.columns)
                if chunk == 0:
                    if out is not None and held >= ARCHIVE_CHUNKS:
                        out.close()
                        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count])], schema=schema)
                        out = None
                    if out is None:
                        filesystem.create_dir(root, recursive=True)
                        name, count, held = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = filesystem.open_output_stream(name, compression=None)
                    carried, count = hashlib.sha1(), count + 1
                    out.write(_member(_header(page_id, url, first, base64.b32encode(bytes.fromhex(sha1)).decode(), size)))
                held += 1
                if data:
                    carried.update(data)
                if chunk == of - 1 and first is None and carried.hexdigest() != sha1:
                    raise ValueError(f"the chunks of page {page_id} are not its payload")
                out.write(_member((data or b"") + (b"\r\n\r\n" if chunk == of - 1 else b"")))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count])], schema=schema)

    table = chunks(records(pages, id_col, url_col, payload_col, least_bytes), chunk_bytes)
    return stage(table.mapInArrow(run, "archive string, records long"), "manifest")[0]


def _place(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def _records_in(stream) -> Iterator[tuple[dict[bytes, bytes], int, str]]:
    """Header fields, length and SHA-1 of the block of each record, read in small pieces."""
    unzip, have, state = zlib.decompressobj(31), b"", "header"
    fields: dict[bytes, bytes] = {}
    left, sha = 0, hashlib.sha1()
    while raw := stream.read(READ_BYTES):
        while raw:
            have += unzip.decompress(raw)
            raw = unzip.unused_data
            if unzip.eof:
                unzip = zlib.decompressobj(31)
            while True:
                if state == "header":
                    end = have.find(b"\r\n\r\n")
                    if end < 0:
                        break
                    first, *lines = have[:end].split(b"\r\n")
                    if first != VERSION:
                        raise ValueError(f"no record where one should begin: {first[:40]!r}")
                    fields, have = dict(x.split(b": ", 1) for x in lines), have[end + 4 :]
                    left, sha, state = int(fields[b"Content-Length"]), hashlib.sha1(), "block"
                if state == "block":
                    part, have = have[:left], have[left:]
                    sha.update(part)
                    left -= len(part)
                    if left:
                        break
                    state = "end"
                if len(have) < 4:
                    break
                have, state = have[4:], "header"
                yield fields, int(fields[b"Content-Length"]), base64.b32encode(sha.digest()).decode()
    if state != "header" or have:
        raise ValueError("the archive ends within a record")


PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(manifest: DataFrame) -> DataFrame:
    """One row per record of the archives: :data:`PAGE`. Blocks are digested as they are read, never held whole."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
    prefix = f"<{RECORD}".encode()

    def page(of: bytes) -> int | None:
        name = of.removeprefix(prefix)[:-1]
        return None if name.startswith(b"none-") else int(name)

    def rows(archive: str) -> Iterator[tuple]:
        filesystem, path = _place(archive)
        with filesystem.open_input_stream(path, compression=None) as stream:
            for fields, size, digest in _records_in(stream):
                kind, declared = fields[b"WARC-Type"].decode(), fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
                if kind == "response" and digest != declared:
                    raise ValueError(f"the block of {fields[b'WARC-Record-ID']!r} is not what was written")
                refers = page(fields[b"WARC-Refers-To"]) if kind == "revisit" else None
                yield page(fields[b"WARC-Record-ID"]), int(fields[b"WARC-Payload-Length"]), declared, kind, refers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column(0).to_pylist():
                found = rows(archive)
                while part := list(islice(found, 4096)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    archives = max(1, manifest.count())
    return manifest.select("archive").repartition(archives).mapInArrow(run, PAGE)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: one row of :data:`PAGE` per page.

    A null payload is empty, and all empty payloads are equal. Pages with equal payload and the smallest id
    repeated are all responses; a page without an id is a response unless a page with an id has its payload. Line
    breaks in an address become blanks. Other columns are left. An empty table gives no archive and no rows.
    """
    return read(write(pages, fresh_path(pages.sparkSession, "warc"), id_col, url_col, payload_col, least_bytes, chunk_bytes))
