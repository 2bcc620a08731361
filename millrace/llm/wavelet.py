"""Token archives: one wavelet matrix file per shard.

Documents are put in order of ``doc_id`` by a range shuffle, encoded word by word in that order, and
cut into shards of ``SHARD`` tokens (a long document runs over several). A shard is a wavelet
matrix: bit-plane k holds bit k of every token (the highest first), in the order that a stable sort
by the planes before leaves. A plane is stored in compressed blocks with the number of ones before
each, so one file answers, from few blocks, which token stands where (``token``), how often a token
occurs in a stretch (``count``), and where it does (``select``, ``occurrences``).

File: magic, blocks, the compressed table of the shard's document pieces, the footer (sizes, zeros of
each plane, places and ones of the blocks), the footer's length, magic. Readers seek from the end.

Words are encoded once while the worker remembers them (by a 64-bit hash). White space, and the place
between a letter and common punctuation, are sure split points of this tokenizer, so words give the
tokens of the whole text.

Cases: NULL and empty texts hold the end token only. Rows without ``doc_id`` come first. Rows that
repeat a ``doc_id`` follow each other in the order of their rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import map_arrow, settle
from millrace.llm.textscan import LOWER, WORD, flags, run_hashes, text_slices
from millrace.llm.vocab import once, tokenizer
from millrace.operators.sizing import with_position
from millrace.scratch import scratch_dir

VOCABULARY = "word_bpe_49k.json"
END = 1
SHARD = 1 << 21
BLOCK_BYTES = 1 << 13
#: Text encoded at a time, and the words and tokens a worker remembers.
PIECE, REMEMBERED, REMEMBERED_IDS = 1 << 21, 1 << 20, 1 << 23
#: Flags of a document piece: its document has an id; the document ends with it.
KNOWN, ENDED = 1, 2
MAGIC = b"WVMX0001"
_SEPARATOR = "<|endoftext|>"
_LETTER = flags(bytes([*range(65, 91), *range(97, 123)]))
_MARK = flags(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")
_PURE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
_HEAD = struct.Struct("<QQQQIII")  # tokens, pieces, place and size of the table, width, blocks, block bytes


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of the stretches between sure split points of the tokenizer.

    Those are white space, and the places between a letter and common punctuation. Not the
    apostrophe, which may begin a contraction, nor the marks of special tokens.
    """
    inside, mark = WORD[data], _MARK[data]
    lead = data == 0xC3  # À to ÿ, but for × and ÷
    after = np.concatenate(([False], lead[:-1]))
    sign = after & ((data == 0x97) | (data == 0xB7))
    letter = _LETTER[data] | (after & ~sign) | (lead & ~np.concatenate((sign[1:], [False])))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[1:-1] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    begin = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~edge[1:])) + 1
    return np.searchsorted(offsets, begin, "right") - 1, begin, end


def byte_letters() -> list[str]:
    """The letter by which the vocabulary writes each byte: printable ones stand for themselves, the
    others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b in set(plain) else chr(256 + others.index(b)) for b in range(256)]


class WordTable:
    """Tokens of words by hash; starts anew when it holds too much."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.model = self.library.model
        self.letters = byte_letters()
        self.separator = self.library.token_to_id(_SEPARATOR)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        parts: list = [None] * len(words)
        for k, word in enumerate(words):
            if _PURE(word):  # letters only: nothing to normalise but their case, nothing to split
                spelled = word.lower()
                if not spelled.isascii():
                    spelled = "".join([self.letters[b] for b in spelled.encode()])
                parts[k] = [token.id for token in self.model.tokenize(spelled)]
        plain = [k for k, w in enumerate(words) if parts[k] is None and "<|" not in w]
        for first in range(0, len(plain), 1024):
            some = plain[first : first + 1024]
            ids = self._ids(_SEPARATOR.join([words[k] for k in some]))
            cuts = np.flatnonzero(ids == self.separator)
            for k, a, b in zip(some, [0, *(cuts + 1)], [*cuts, len(ids)]):
                parts[k] = ids[a:b]
        for k, word in enumerate(words):
            if parts[k] is None:
                parts[k] = self._ids(word)
        size = np.array([len(p) for p in parts], np.int64)
        begin = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(parts), np.uint32, int(size.sum()))))
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin, self.size = np.insert(self.begin, at, begin), np.insert(self.size, at, size)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of some texts one after the other, and their number per text."""
        if b"<|" not in data.tobytes():  # special tokens are told by their case
            data = LOWER[data]
        row, first, last = units(data, offsets)
        if not len(row):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        lengths = last - first
        hashes = run_hashes(data, np.flatnonzero(WORD[data]), np.cumsum(lengths) - lengths, lengths)
        if len(self.keys) > REMEMBERED or len(self.ids) > REMEMBERED_IDS:
            self._clear()
        keys, one, each = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        fresh = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        fresh[inside] = self.keys[at[inside]] != keys[inside]
        if fresh.any():
            some = one[fresh]
            raw = data.tobytes()
            spans = zip(first[some].tolist(), last[some].tolist())
            self._learn(keys[fresh], [raw[a:b].decode() for a, b in spans])
            at = np.searchsorted(self.keys, keys)
        begin, size = self.begin[at][each], self.size[at][each]
        before = np.cumsum(size) - size
        ids = self.ids[np.arange(size.sum()) + np.repeat(begin - before, size)]
        return ids, np.bincount(row, size, len(offsets) - 1).astype(np.int64)


def encoded(column: pa.Array, table: WordTable) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Tokens of a column's texts: row, tokens, and whether the row ends with them.

    A text longer than ``PIECE`` comes in pieces that end at white space.
    """
    for first, data, offsets in text_slices(column, PIECE):
        rows = len(offsets) - 1
        if rows == 1 and len(data) > PIECE:
            start = 0
            while len(data) - start > PIECE:
                # the last white space of the piece, or the first one after it in a very long word
                spaces = np.flatnonzero(~WORD[data[start : start + PIECE]])
                if len(spaces):
                    end = start + int(spaces[-1]) + 1
                else:
                    beyond = np.flatnonzero(~WORD[data[start + PIECE :]])
                    end = start + PIECE + int(beyond[0]) if len(beyond) else len(data)
                part = data[start:end]
                yield first, table.encode(part, np.array([0, len(part)]))[0], False
                start = end
            part = data[start:]
            yield first, table.encode(part, np.array([0, len(part)]))[0], True
            continue
        ids, counts = table.encode(data, offsets)
        for k, part in enumerate(np.split(ids, np.cumsum(counts)[:-1])):
            yield first + k, part, True


def _pack(blob: bytes) -> bytes:
    """Compressed if that is shorter; the first byte tells."""
    short = pa.compress(blob, codec="zstd", asbytes=True)
    return b"\1" + short if len(short) < len(blob) else b"\0" + blob


def _unpack(blob: bytes, size: int) -> bytes:
    if blob[:1] == b"\0":
        return blob[1:]
    return pa.decompress(blob[1:], decompressed_size=size, codec="zstd", asbytes=True)


def write_shard(out, tokens: np.ndarray, pieces: np.ndarray) -> int:
    """Write a shard; ``pieces`` has int64 rows of document number, doc_id, flags, piece, length."""
    width = max(1, int(tokens.max(initial=0)).bit_length())
    blocks = -(-len(tokens) // (8 * BLOCK_BYTES))
    at = out.write(MAGIC)
    if width <= 16:
        tokens = tokens.astype(np.uint16)
    zeros = np.zeros(width, np.uint64)
    places = np.zeros(width * blocks + 1, np.uint64)
    ones = np.zeros((width, blocks + 1), np.uint64)
    places[0] = at
    for level in range(width):
        bits = tokens & tokens.dtype.type(1 << (width - 1 - level)) != 0
        zeros[level] = len(tokens) - np.count_nonzero(bits)
        plane = np.packbits(bits)
        for k in range(blocks):
            block = plane[k * BLOCK_BYTES : (k + 1) * BLOCK_BYTES]
            at += out.write(_pack(block.tobytes()))
            places[level * blocks + k + 1] = at
            ones[level, k + 1] = ones[level, k] + np.uint64(_ONES[block].sum())
        tokens = np.concatenate((tokens[~bits], tokens[bits]))
    raw = np.ascontiguousarray(pieces, "<i8").tobytes()
    listed = _pack(raw)
    out.write(listed)
    footer = _HEAD.pack(len(tokens), len(pieces), at, len(listed), width, blocks, BLOCK_BYTES)
    footer += zeros.tobytes() + places.tobytes() + ones.tobytes()
    out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
    return at + len(listed) + len(footer) + 4 + len(MAGIC)


_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


class WaveletFile:
    """Reads a shard file: whole, or only the blocks that a question needs."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        tail = self._read(max(0, size - 4 - len(MAGIC)), 4 + len(MAGIC))
        if tail[4:] != MAGIC:
            raise ValueError("not a shard file, or cut off")
        length = struct.unpack("<I", tail[:4])[0]
        footer = self._read(size - 4 - len(MAGIC) - length, length)
        head = _HEAD.unpack_from(footer)
        self.n, self._pieces, self._table, self._table_size, self.width, self.blocks, self.block_bytes = head
        rest = np.frombuffer(footer, "<u8", offset=_HEAD.size).astype(np.int64)
        self.zeros = rest[: self.width]
        self.places = rest[self.width : self.width + self.width * self.blocks + 1]
        self.ones = rest[self.width + len(self.places) :].reshape(self.width, self.blocks + 1)
        self._held: dict[int, np.ndarray] = {}

    def _read(self, at: int, length: int) -> bytes:
        self.source.seek(at)
        return self.source.read(length)

    def _block_bytes(self, block: int) -> int:
        return min(self.block_bytes, -(-self.n // 8) - block * self.block_bytes)

    def _block(self, level: int, block: int) -> np.ndarray:
        """Bits of one block; the last few blocks read are kept."""
        number = level * self.blocks + block
        if number not in self._held:
            if len(self._held) >= 4 * self.width:
                self._held.pop(next(iter(self._held)))
            a, b = int(self.places[number]), int(self.places[number + 1])
            raw = _unpack(self._read(a, b - a), self._block_bytes(block))
            first = block * 8 * self.block_bytes
            self._held[number] = np.unpackbits(np.frombuffer(raw, np.uint8))[: self.n - first]
        return self._held[number]

    def pieces(self) -> np.ndarray:
        """Document number, doc_id, flags, piece and length of every document piece."""
        raw = _unpack(self._read(self._table, self._table_size), 40 * self._pieces)
        return np.frombuffer(raw, "<i8").reshape(-1, 5)

    def _rank(self, level: int, at: int) -> int:
        """Ones of a plane before a place."""
        block, inside = divmod(at, 8 * self.block_bytes)
        if not inside:
            return int(self.ones[level, block])
        return int(self.ones[level, block]) + int(np.count_nonzero(self._block(level, block)[:inside]))

    def _find(self, level: int, bit: int, nth: int) -> int:
        """Place of the nth one or zero of a plane, from 0."""
        before = self.ones[level]
        if not bit:
            before = np.minimum(np.arange(self.blocks + 1) * 8 * self.block_bytes, self.n) - before
        block = int(np.searchsorted(before, nth, "right")) - 1
        inside = np.flatnonzero(self._block(level, block) == bit)
        return block * 8 * self.block_bytes + int(inside[nth - int(before[block])])

    def token(self, at: int) -> int:
        """The token at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level in range(self.width):
            block, inside = divmod(at, 8 * self.block_bytes)
            bit = int(self._block(level, block)[inside])
            rank = self._rank(level, at)
            at = int(self.zeros[level]) + rank if bit else at - rank
            value = 2 * value + bit
        return value

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the occurrences of a token within a stretch lie after the last plane."""
        if token < 0 or token >> self.width:
            return 0, 0
        for level in range(self.width):
            if low >= high:
                return 0, 0
            a, b = self._rank(level, low), self._rank(level, high)
            if token >> (self.width - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, max(low, high)

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often a token occurs from ``low`` to before ``high``."""
        low, high = self._range(token, max(0, low), self.n if high is None else min(high, self.n))
        return high - low

    def select(self, token: int, nth: int) -> int:
        """Place of the nth occurrence of a token, from 0."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        at = low + nth
        for level in reversed(range(self.width)):
            if token >> (self.width - 1 - level) & 1:
                at = self._find(level, 1, at - int(self.zeros[level]))
            else:
                at = self._find(level, 0, at)
        return at

    def occurrences(self, token: int, low: int = 0, high: int | None = None) -> Iterator[int]:
        """Places of a token within a stretch, in order."""
        before = self.count(token, 0, low)
        for nth in range(before, before + self.count(token, low, high)):
            yield self.select(token, nth)

    def _plane(self, level: int) -> np.ndarray:
        """All bits of a plane."""
        numbers = range(level * self.blocks, (level + 1) * self.blocks)
        base = int(self.places[level * self.blocks])
        raw = self._read(base, int(self.places[(level + 1) * self.blocks]) - base)
        blocks = [
            _unpack(raw[int(self.places[k]) - base : int(self.places[k + 1]) - base], self._block_bytes(k - numbers[0]))
            for k in numbers
        ]
        return np.unpackbits(np.frombuffer(b"".join(blocks), np.uint8))[: self.n].view(bool)

    def tokens(self) -> np.ndarray:
        """All tokens in order: from the lowest plane up, each plane says where the numbers that the
        planes below it make up came from."""
        kind = np.uint16 if self.width <= 16 else np.uint32
        low = np.zeros(self.n, kind)
        for level in reversed(range(self.width)):
            bits, zeros = self._plane(level), int(self.zeros[level])
            above = np.empty_like(low)
            above[~bits] = low[:zeros]
            above[bits] = low[zeros:] | kind(1 << (self.width - 1 - level))
            low = above
        return low.astype(np.uint32)


def write_shards(docs: DataFrame, folder: str, path: str | None = None, shard: int = SHARD) -> DataFrame:
    """Write all documents in ``doc_id`` order below ``folder``; a row per file, in order of ``task``
    and ``shard``. Only files that this table lists belong to the archive: a task that runs again
    names its files afresh."""
    path = path or public_tokenizers.path(VOCABULARY)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = once(("word table", path), lambda: WordTable(path))
        system, place = fs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        task, number = TaskContext.get().partitionId(), 0
        held, room, pieces = [], shard, []

        def flush() -> pa.RecordBatch:
            nonlocal held, room, pieces, number
            name = f"{uuid.uuid4().hex}.wvm"
            tokens = np.concatenate(held)
            with system.open_output_stream(f"{place}/{name}", compression=None) as out:
                size = write_shard(out, tokens, np.array(pieces, np.int64).reshape(-1, 5))
            row = {"task": [task], "shard": [number], "path": [name], "tokens": [len(tokens)], "bytes": [size]}
            held, room, pieces, number = [], shard, [], number + 1
            return pa.RecordBatch.from_pydict(row, _LISTED)

        document, piece, length = 0, 0, 0  # of the document being written
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for row, ids, last in encoded(batch.column("text"), table):
                if last:
                    ids = np.append(ids, np.uint32(END))
                doc_id = doc_ids[row]
                while True:
                    part, ids = ids[:room], ids[room:]
                    held.append(part)
                    room -= len(part)
                    length += len(part)
                    ended = last and not len(ids)
                    if (ended or not room) and length:
                        flags = KNOWN * (doc_id is not None) + ENDED * ended
                        pieces.append((document, doc_id or 0, flags, piece, length))
                        piece, length = piece + 1, 0
                    if ended:
                        document, piece = document + 1, 0
                    if not room:
                        yield flush()
                    if not len(ids):
                        break
        if held:
            yield flush()

    rows = with_position(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "row")
    ordered = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    found = map_arrow(ordered.drop("row"), write, "task int, shard int, path string, tokens long, bytes long")
    return found.withColumn("path", F.concat(F.lit(folder + "/"), "path"))


_LISTED = pa.schema(
    [("task", pa.int32()), ("shard", pa.int32()), ("path", pa.string()), ("tokens", pa.int64()), ("bytes", pa.int64())]
)


def with_start(files: DataFrame) -> DataFrame:
    """Add ``before``: the tokens of all earlier files. One row per task meets in one place."""
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("task").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    tasks = files.groupBy("task").agg(F.sum("tokens").alias("all"))
    tasks = tasks.select("task", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("tasks_before"))
    inside = F.coalesce(F.sum("tokens").over(within), F.lit(0))
    return (
        files.withColumn("inside", inside)
        .join(tasks, "task")
        .withColumn("before", F.col("tasks_before") + F.col("inside"))
        .drop("tasks_before", "inside")
    )


def _dealt(files: DataFrame) -> DataFrame:
    """A few files a task: the list is tiny, its files are not."""
    return files.repartition(max(1, min(files.count(), 100_000)), "path")


def _open(path: str) -> WaveletFile:
    system, place = fs.FileSystem.from_uri(path)
    return WaveletFile(system.open_input_file(place))


def read_pieces(files: DataFrame) -> DataFrame:
    """Every document piece as read back: place, length and CRC-32 of its tokens."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = _open(row["path"])
                tokens, pieces = shard.tokens().astype("<u4"), shard.pieces()
                ends = np.cumsum(pieces[:, 4])
                starts = ends - pieces[:, 4]
                raw = memoryview(tokens).cast("B")
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pieces), row["task"], np.int64)),
                        pa.array(pieces[:, 0]),
                        pa.array(pieces[:, 1], mask=pieces[:, 2] & KNOWN == 0),
                        pa.array(pieces[:, 3]),
                        pa.array(row["before"] + starts),
                        pa.array(pieces[:, 4]),
                        pa.array(crcs, pa.int64()),
                        pa.array(pieces[:, 2] & ENDED != 0),
                    ],
                    names=[part.split()[0] for part in _PIECES.split(", ")],
                )

    return map_arrow(_dealt(with_start(files)), read, _PIECES)


_PIECES = "task long, document long, doc_id long, piece long, start long, n_tokens long, ids_crc32 long, last boolean"


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if not vector:
            break
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def crc_joined(first: int, second: int, length: int) -> int:
    """CRC-32 of two byte strings one after the other, from those of each and the second's length."""
    step = [0xEDB88320, *(1 << k for k in range(31))]  # the effect of one zero bit
    for _ in range(3):
        step = [_times(step, row) for row in step]  # of one zero byte
    while length:
        if length & 1:
            first = _times(step, first)
        step = [_times(step, row) for row in step]
        length >>= 1
    return first ^ second


def read_documents(files: DataFrame) -> DataFrame:
    """Every document as read back from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Only documents that run over several files are gathered, as lengths and digests.
    """
    pieces = settle(read_pieces(files), "pieces")
    whole = (F.col("piece") == 0) & F.col("last")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    parts = (
        pieces.where(~whole)
        .groupBy("task", "document")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.min("start").alias("start"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sort_array(F.collect_list(F.struct("piece", "ids_crc32", "n_tokens"))).alias("parts"),
        )
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = []
            for row in batch.column("parts").to_pylist():
                crc = 0
                for part in row:
                    crc = crc_joined(crc, part["ids_crc32"], 4 * part["n_tokens"])
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], names=names)

    joined = map_arrow(
        parts.select("doc_id", "start", "n_tokens", "parts"), join,
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )
    return pieces.where(whole).select(*names).unionByName(joined)


def occurrences(files: DataFrame, tokens: list[int]) -> DataFrame:
    """Where the given tokens stand: ``token``, ``doc_id``, ``place`` among all tokens. Reads only the
    blocks that lead to them."""
    wanted = sorted(set(tokens))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = _open(row["path"])
                pieces = shard.pieces()
                ends = np.cumsum(pieces[:, 4])
                for token in wanted:
                    places = np.fromiter(shard.occurrences(token), np.int64)
                    of = np.searchsorted(ends, places, "right")
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(places), token, np.int64)),
                            pa.array(pieces[of, 1], mask=pieces[of, 2] & KNOWN == 0),
                            pa.array(row["before"] + places),
                        ],
                        names=["token", "doc_id", "place"],
                    )

    return map_arrow(_dealt(with_start(files)), look, "token long, doc_id long, place long")


def token_counts(files: DataFrame, tokens: list[int]) -> DataFrame:
    """How often each given token occurs: ``token``, ``n``. Reads at most two blocks a plane."""
    wanted = sorted(set(tokens))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                shard = _open(path)
                yield pa.RecordBatch.from_pydict(
                    {"token": pa.array(wanted, pa.int64()), "n": pa.array([shard.count(t) for t in wanted], pa.int64())}
                )

    found = map_arrow(_dealt(files), look, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def token_archive(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archive, read it back, and describe every document as read."""
    folder = folder or scratch_dir(docs.sparkSession, "llm-wavelet")
    return read_documents(settle(write_shards(docs, folder), "shards"))
