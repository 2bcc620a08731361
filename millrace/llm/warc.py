"""WARC archives through a chunked record table.

Writing: a payload becomes rows of record identifier and chunk number, cut from the input's buffer,
and a task streams them into gzipped archives, each record a member of its own. Reading: a task
streams an archive back into the same kind of rows. Digests are carried from chunk to chunk on both
sides; on reading every chunk row has the digest of the payload up to its end, so digests,
lengths and types come from the last chunk of each record. What is shuffled, sorted, written and read
is a chunk at a time; only the cell of the input table itself is read whole.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the first by ``page_id`` is
written whole, the others as revisits that name it. Equal payloads meet by a grouped minimum over
digests, without the payloads; the join back leaves a much-repeated digest to Spark's splitting of
skewed keys.

Archives lie below the shared checkpoint folder. A task names its files afresh at every attempt and
returns them as rows; only files of finished tasks are read, so a task may be run again.

Cases: NULL html is an empty payload of one empty chunk. Rows that repeat the first ``page_id`` of
a payload revisit it; rows without ``page_id`` are written and come after all others in that order.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_arrow, settle
from millrace.operators.sizing import with_position
from millrace.scratch import scratch_dir

MIN_REVISIT = 100
CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAME = "urn:page"
HEAD = -1  # chunk number of the row that describes a record


def numbered(pages: DataFrame) -> DataFrame:
    """Pages with a row number that later scans repeat."""
    return with_position(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), "row")


def _payloads(column: pa.Array) -> Iterator[memoryview]:
    """The bytes of each text where they lie in the Arrow buffer, not copied; NULL is empty."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = memoryview(offsets).cast("q")
    whole = memoryview(data if data is not None else b"")
    for at, known in enumerate(column.is_valid().to_pylist(), column.offset):
        yield whole[ends[at] : ends[at + 1] if known else ends[at]]


def _slices(payload: memoryview, chunk_bytes: int) -> Iterator[memoryview]:
    """Chunks of a payload as views; an empty payload is one empty chunk."""
    for begin in range(0, max(len(payload), 1), chunk_bytes):
        yield payload[begin : begin + chunk_bytes]


def payload_digests(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Size and digest of every numbered payload, the digest carried from chunk to chunk."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = [], []
            for payload in _payloads(batch.column("html")):
                digest = hashlib.sha256()
                for chunk in _slices(payload, chunk_bytes):
                    digest.update(chunk)
                sizes.append(len(payload))
                digests.append(digest.hexdigest())
            known = {name: batch.column(name) for name in ("row", "page_id", "url")}
            yield pa.RecordBatch.from_pydict(
                known | {"size": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.string())}
            )

    return map_arrow(pages, scan, "row long, page_id long, url string, size long, digest string")


def record_heads(digests: DataFrame) -> DataFrame:
    """What each record's head says: digest, size, and which record it revisits, if any.

    Works on digests alone; payloads are not moved for it.
    """
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row")
    first = (
        digests.where(f"size >= {MIN_REVISIT}")
        .groupBy("digest")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_id"))
    )
    revisit = F.coalesce(F.col("first_row") != F.col("row"), F.lit(False))
    return digests.join(first, "digest", "left").select(
        *["row", "page_id", "url", "digest", "size"],
        revisit.alias("revisit"),
        F.when(revisit, F.col("first_id")).alias("first_id"),
    )


_CHUNKS = pa.schema({"row": pa.int64(), "chunk_no": pa.int32(), "chunk": pa.binary()})


def payload_chunks(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row per numbered page and chunk, cut from the input's buffer; a batch holds about one chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row, payload in zip(batch.column("row").to_pylist(), _payloads(batch.column("html"))):
                for number, chunk in enumerate(_slices(payload, chunk_bytes)):
                    held.append((row, number, bytes(chunk)))
                    size += len(chunk) + 100
                    if size >= chunk_bytes:
                        yield _batch(held)
                        held, size = [], 0
            if held:
                yield _batch(held)

    return map_arrow(pages.select("row", "html"), cut, "row long, chunk_no int, chunk binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), _CHUNKS.types)]
    return pa.RecordBatch.from_arrays(columns, schema=_CHUNKS)


def chunk_rows(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table, ready to write: for each record a head row, then its chunks in order.

    Heads are numbered -1 and meet their chunks by the shuffle that deals records to tasks, so no
    join carries payloads. Chunks of revisits are there too; the writer passes over them.
    """
    known = numbered(pages)
    heads = settle(record_heads(payload_digests(known, chunk_bytes)), "records")
    rows = heads.withColumn("chunk_no", F.lit(HEAD)).unionByName(
        payload_chunks(known, chunk_bytes), allowMissingColumns=True
    )
    return rows.repartition("row").sortWithinPartitions("row", "chunk_no")


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def record_head(page_id, copy: int, url: str, digest: str, size: int, first_id) -> bytes:
    """WARC and HTTP header of a record; ``first_id`` is a string for a revisit."""
    revisit = first_id is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{_NAME}:{'' if page_id is None else page_id}:{copy}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_NAME}:{first_id}:0>"]
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def write_archives(chunks: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Stream chunk rows into archives below ``folder``; returns a row per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = _folder(folder)
        system.create_dir(place, recursive=True)
        out = packer = None
        name, records, size = "", 0, 0
        due, skip = None, False  # the next chunk, of a record that is a revisit or not
        for batch in batches:
            column = {k: batch.column(k) for k in batch.schema.names}
            numbers, idents = column["chunk_no"].to_pylist(), column["row"].to_pylist()
            for at, (ident, number) in enumerate(zip(idents, numbers)):
                if number != HEAD:
                    if due != (ident, number):
                        raise ValueError(f"chunk {number} of row {ident} is out of order")
                    due = (ident, number + 1)
                    if not skip:
                        size += out.write(packer.compress(column["chunk"][at].as_buffer()))
                    continue
                if packer:
                    size += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                if out and size >= archive_bytes:
                    out.close()
                    yield _listed(name, records, size)
                    out = None
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = system.open_output_stream(f"{place}/{name}", compression=None)
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                about = {k: column[k][at].as_py() for k in column if k not in ("row", "chunk_no", "chunk")}
                skip = about.pop("revisit")
                first = about.pop("first_id")
                named = ("" if first is None else first) if skip else None
                size += out.write(packer.compress(record_head(copy=int(skip), first_id=named, **about)))
                records += 1
                due = (ident, 0)
        if out:
            size += out.write(packer.compress(b"\r\n\r\n") + packer.flush())
            out.close()
            yield _listed(name, records, size)

    found = map_arrow(chunks, write, "path string, records long, bytes long")
    return found.withColumn("path", F.concat(F.lit(folder + "/"), "path"))


def _listed(name: str, records: int, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [name], "records": [records], "bytes": [size]})


class _Members:
    """Reads a gzip file of many members as one stream of bytes, a piece at a time."""

    def __init__(self, source, piece: int = 1 << 18):
        self.source, self.piece = source, piece
        self.packed, self.plain = b"", bytearray()
        self.unpacker = zlib.decompressobj(31)
        self.open = False  # inside a member

    def _more(self) -> bool:
        if self.unpacker.eof:
            self.packed, self.unpacker = self.unpacker.unused_data, zlib.decompressobj(31)
            self.open = False
        size = len(self.plain)
        if not self.packed:  # the unpacker may still hold bytes beyond the last piece
            self.plain += self.unpacker.decompress(b"", self.piece)
            if len(self.plain) > size:
                return True
            self.packed = self.source.read(self.piece)
            if not self.packed and self.open:
                raise ValueError("the archive ends inside a record")
            if not self.packed:
                return False
        self.open = True
        self.plain += self.unpacker.decompress(self.packed, self.piece)
        self.packed = self.unpacker.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with the next mark; what is left at the end of the stream."""
        seen = 0
        while (at := self.plain.find(mark, seen)) < 0:
            seen = max(0, len(self.plain) - len(mark) + 1)
            if not self._more():
                at = len(self.plain) - len(mark)
                break
        found = bytes(self.plain[: at + len(mark)])
        del self.plain[: at + len(mark)]
        return found

    def up_to(self, n: int) -> bytes:
        while len(self.plain) < n and self._more():
            pass
        found = bytes(self.plain[:n])
        del self.plain[:n]
        return found


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def read_stream(source, chunk_bytes: int = CHUNK_BYTES) -> Iterator[dict]:
    """Chunk rows of one archive, each with the digest of its payload so far."""
    stream = _Members(source)
    while head := stream.until(b"\r\n\r\n"):
        if not head.strip():
            continue
        warc = _fields(head)
        http_head = stream.until(b"\r\n\r\n")
        left = int(warc["content-length"]) - len(http_head)
        digest, number, done = hashlib.sha256(), 0, 0
        while True:
            chunk = stream.up_to(min(left, chunk_bytes))
            if len(chunk) < min(left, chunk_bytes):
                raise ValueError(f"the archive ends inside {warc.get('warc-record-id')}")
            digest.update(chunk)
            left -= len(chunk)
            done += len(chunk)
            yield {
                "record_id": warc["warc-record-id"].strip("<>"),
                "record_type": warc["warc-type"],
                "refers_to_id": warc.get("warc-refers-to", "").strip("<>") or None,
                "uri": warc.get("warc-target-uri"),
                "declared_bytes": int(_fields(http_head).get("content-length", done + left)),
                "declared_digest": warc.get("warc-payload-digest", "").rpartition(":")[2],
                "chunk_no": number,
                "chunk": chunk,
                "bytes_so_far": done,
                "digest_so_far": digest.hexdigest(),
                "last": left == 0,
            }
            number += 1
            if not left:
                break
        if stream.up_to(4) != b"\r\n\r\n":
            raise ValueError(f"no end of record after {warc.get('warc-record-id')}")


_READ = {
    "record_id": pa.string(),
    "record_type": pa.string(),
    "refers_to_id": pa.string(),
    "uri": pa.string(),
    "declared_bytes": pa.int64(),
    "declared_digest": pa.string(),
    "chunk_no": pa.int64(),
    "chunk": pa.binary(),
    "bytes_so_far": pa.int64(),
    "digest_so_far": pa.string(),
    "last": pa.bool_(),
}
_KINDS = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}


def read_archives(archives: DataFrame, data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives a manifest lists, a task per archive.

    Without ``data`` the chunks themselves stay behind; their lengths and digests come along.
    """
    fields = {k: t for k, t in _READ.items() if data or k != "chunk"}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = _folder(path)
                with system.open_input_stream(place, compression=None) as source:
                    rows, held = [], 0
                    for row in read_stream(source, chunk_bytes):
                        rows.append({k: row[k] for k in fields})
                        held += len(row["chunk"]) if data else 100
                        if held > chunk_bytes:
                            yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    # as many partitions as archives: a manifest is tiny, its rows are not
    count = archives.count()
    spread = archives.select("path").repartition(max(1, min(count, 100_000)), "path")
    return map_arrow(spread, read, ", ".join(f"{k} {_KINDS[t]}" for k, t in fields.items()))


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a record per page, read the archives back, and describe each record as read."""
    folder = folder or scratch_dir(pages.sparkSession, "llm-warc")
    manifest = settle(write_archives(chunk_rows(pages), folder), "archives")
    last = read_archives(manifest, data=False).where("last")
    number = lambda name: F.split(name, ":")[2].try_cast("long")
    revisit = F.col("record_type") == "revisit"
    sound = revisit | (F.col("digest_so_far") == F.col("declared_digest"))
    return last.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest"))
        .when(sound, F.col("digest_so_far"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id")))
        .alias("payload_digest"),
        "record_type",
        number("refers_to_id").alias("refers_to"),
    )
