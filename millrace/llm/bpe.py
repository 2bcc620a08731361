"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes cuts every text where its low bits are zero, so a passage that
several documents share falls into the same chunks in each. A chunk's tokens are kept in a bounded
memory of the worker and reused by every document that holds the chunk. A cut may split a word, so
the tokens beside a cut can't be trusted: the join is encoded again, from the last sure split point
before the cut to the first one after it, over as many chunks as that takes. White space is a sure
split point of this tokenizer, so the joined tokens agree exactly with those of the whole text.

Keeping the memory in the worker is deliberate: encoding each chunk once in the whole cluster needs
a shuffle of all text and another of all tokens, several times the size of the input, to save the
few chunks that two workers share.

Cases: NULL and empty texts have no tokens. Texts with control characters on whose nature as white
space the libraries differ are encoded whole. Repeated rows and NULL ids give a row each.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_arrow
from millrace.llm.textscan import mix, text_slices
from millrace.llm.vocab import Memory, once, tokenizer

VOCABULARY = "word_bpe_49k.json"
#: Chunks end where this many low bits of the rolling hash are zero, every 512 bytes on average.
CUT_BITS = 9
WINDOW = 16
WORDS, CHUNKS = 200_000, 12_000
_SEPARATOR = "<|endoftext|>"
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_GEAR = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions before which a chunk ends; never inside a character."""
    rolled = _GEAR[data]
    width = 1
    while width < WINDOW:  # doubles the window: byte i carries the hash of the last `width` bytes
        shifted = np.zeros_like(rolled)
        shifted[width:] = rolled[:-width] << np.uint32(width)
        rolled = rolled + shifted
        width *= 2
    at = np.flatnonzero((rolled >> np.uint32(WINDOW)) & np.uint32((1 << CUT_BITS) - 1) == 0) + 1
    at = at[at < len(data)]
    for _ in range(3):  # a character has three bytes at most after its first
        inside = (data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80
        at = np.unique(at + inside)
    return at[at < len(data)]


class Chunk:
    """A chunk's parts: text before its first and after its last split point, tokens between."""

    __slots__ = ("head", "tail", "words", "ids", "tokens", "solid")

    def __init__(self, text: str):
        words = text.split()
        self.solid = bool(words) and len(words) == 1 and len(words[0]) == len(text)
        self.head = words.pop(0) if words and not text[0].isspace() else ""
        self.tail = words.pop() if words and not text[-1].isspace() else ""
        if self.head and not self.tail and len(self.head) == len(text):
            self.tail = ""
        self.words, self.ids, self.tokens = words, b"", b""


class WordEncoder:
    """Encodes and decodes whole texts through chunk and word memories."""

    def __init__(self, path: str):
        self.whole = tokenizer(path)
        self.words, self.chunks = Memory(WORDS), Memory(CHUNKS)
        self.separator = self.whole.token_to_id(_SEPARATOR)
        size = self.whole.get_vocab_size(with_added_tokens=True)
        self.token = [(self.whole.id_to_token(i) or "").encode() for i in range(size)]

    def _pair(self, ids: list[int]) -> tuple[bytes, bytes]:
        return " ".join(map(str, ids)).encode(), b" ".join([self.token[i] for i in ids])

    def _learn(self, words: set[str]) -> None:
        """Encode the words not remembered: many in one call, apart by the separator token."""
        fresh = self.words.missing(words)
        marked = [w for w in fresh if "<|" in w]
        fresh = [w for w in fresh if "<|" not in w]
        for first in range(0, len(fresh), 512):
            some = fresh[first : first + 512]
            ids = self.whole.encode(_SEPARATOR.join(some), add_special_tokens=False).ids
            parts, start = [], 0
            for _ in some[1:]:
                end = ids.index(self.separator, start)
                parts.append(ids[start:end])
                start = end + 1
            parts.append(ids[start:])
            self.words.add(zip(some, map(self._pair, parts)))
        for word in marked:
            ids = self.whole.encode(word, add_special_tokens=False).ids
            self.words.add([(word, self._pair(ids))])

    def encode(self, chunked: list[list[str] | str]) -> list[tuple[bytes, bytes]]:
        """Ids and tokens, joined by blanks, of texts given as chunks, or whole as one string."""
        texts = [c for c in chunked if not isinstance(c, str)]
        fresh = {c: Chunk(c) for c in self.chunks.missing(c for t in texts for c in t)}
        known = self.chunks.young
        at = lambda c: fresh.get(c) or known[c]
        joins = [list(self._joins([at(c) for c in t])) for t in texts]
        need = {w for c in fresh.values() for w in c.words}
        need.update(w for pieces in joins for w in pieces if isinstance(w, str))
        self._learn(need)
        word = self.words.young
        for chunk in fresh.values():
            pairs = [word[w] for w in chunk.words]
            chunk.ids = b" ".join([p[0] for p in pairs if p[0]])
            chunk.tokens = b" ".join([p[1] for p in pairs if p[0]])
            chunk.words = ()
        out, each = [], iter(joins)
        for chunks in chunked:
            if isinstance(chunks, str):
                out.append(self._pair(self.whole.encode(chunks, add_special_tokens=False).ids))
                continue
            parts = [
                word[p] if isinstance(p, str) else (p.ids, p.tokens) for p in next(each)
            ]
            out.append(
                (b" ".join([p[0] for p in parts if p[0]]), b" ".join([p[1] for p in parts if p[0]]))
            )
        self.chunks.add(fresh.items())
        self.chunks.trim()
        self.words.trim()
        return out

    @staticmethod
    def _joins(chunks: list[Chunk]) -> Iterator[Chunk | str]:
        """The chunks of a text and, between them, the words that their joins complete."""
        open_word = ""
        for chunk in chunks:
            open_word += chunk.head
            if chunk.solid:  # no split point yet: the join runs on into the next chunk
                continue
            if open_word:
                yield open_word
            yield chunk
            open_word = chunk.tail
        if open_word:
            yield open_word


def chunk_texts(column: pa.Array) -> Iterator[list[list[str] | str]]:
    """The texts of a column as lists of chunks, slice by slice."""
    for _, data, offsets in text_slices(column):
        places = np.unique(np.concatenate((cuts(data), offsets)))
        bounds = np.searchsorted(places, offsets)
        raw = data.tobytes()
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            chunks = [
                raw[places[k] : places[k + 1]].decode() for k in range(a, b)
            ]
            text = "".join(chunks)
            out.append(text if _ODD_SPACE.search(text) else chunks)
        yield out


def encode_documents(docs: DataFrame, path: str | None = None, full: bool = False) -> DataFrame:
    """Token count and digests of ids and decoded text of every document.

    ``full`` adds ``ids`` (decimal, joined by blanks) and ``decoded``.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("words", path), lambda: WordEncoder(path))
        for batch in batches:
            first = 0
            for texts in chunk_texts(batch.column("text")):
                pairs = encoder.encode(texts)
                arrays = [
                    batch.column("doc_id").slice(first, len(texts)),
                    pa.array([ids.count(b" ") + 1 if ids else 0 for ids, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids, _ in pairs], pa.string()),
                    pa.array([hashlib.sha256(text).hexdigest() for _, text in pairs], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if full:
                    arrays += [pa.array([p[k].decode() for p in pairs], pa.string()) for k in (0, 1)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                first += len(texts)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, encode, schema + ", ids string, decoded string" * full)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for batch in batches:
        found: Counter[tuple[int, int]] = Counter()
        for texts in chunk_texts(batch.column("text")):
            for text in texts:
                for chunk in [text] if isinstance(text, str) else text:
                    raw = chunk.encode()
                    found[xxhash.xxh64_intdigest(raw) - (1 << 63), len(raw)] += 1
        hashes, sizes = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([task] * len(hashes), pa.int32()),
                pa.array(hashes, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(found.values(), pa.int64()),
            ],
            names=["task", "hash", "size", "n"],
        )


def chunk_reuse(docs: DataFrame) -> DataFrame:
    """How far chunk reuse can go: one row of chunk counts and bytes of all texts.

    ``n_chunks`` and ``n_bytes`` are those of all texts, ``task_*`` what is left when every task encodes
    a chunk once (with unbounded memory), ``distinct_*`` what is left when the whole cluster does.
    Chunks are told apart by a 64-bit hash and their size; texts encoded whole count as one chunk.
    Only hashes are shuffled, counted per batch first. NULL and empty texts have no chunks.
    """
    slim = docs.select("text").where(F.length("text") > 0)
    counted = map_arrow(slim, _count_chunks, "task int, hash long, size long, n long")
    by_task = counted.groupBy("hash", "size", "task").agg(F.sum("n").alias("n"))
    chunks = by_task.groupBy("hash", "size").agg(F.sum("n").alias("n"), F.count("*").alias("tasks"))
    total = lambda count: F.coalesce(F.sum(count), F.lit(0))
    return chunks.agg(
        total(F.col("n")).alias("n_chunks"),
        total(F.col("tasks")).alias("task_chunks"),
        F.count("*").alias("distinct_chunks"),
        total(F.col("n") * F.col("size")).alias("n_bytes"),
        total(F.col("tasks") * F.col("size")).alias("task_bytes"),
        total("size").alias("distinct_bytes"),
    )
