"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm.

Documents of one length are interchangeable, so a packing is a list of patterns, the lengths that
share a sequence, each with the number of sequences that follow it. A genome is such a list: its
size depends on the 2,048 possible lengths and not on the number of documents, of which all are
counted. Crossover injects whole well-filled sequences of one parent into the other, removes the
sequences that would hold a document twice, and best-fits the displaced documents. Islands evolve
as tasks of their own and hand their elites round a ring between the rounds.

The documents themselves are then placed without being gathered: a piece's rank among the pieces
of its length (its place in its task, plus the count in earlier tasks) names its slot.

Cases: NULL or empty text is the lone id 0. A document longer than a sequence is cut, the short
piece first. Rows are packed one by one, so repeated rows and NULL ids are packed as well. An empty
table gives an empty packing. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import pickle
import random
import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import map_arrow, per_group, settle
from millrace.llm.vocab import once, ranked, tokenizer

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k"
ISLANDS, ROUNDS, GENERATIONS, POPULATION = 6, 3, 8, 6
_SPECIAL = "<|endoftext|>"
#: Control characters that are white space for some pattern engines only, and letters outside
#: blocks that have been settled for long: texts with one are left to the tokenizers library.
_UNUSUAL = re.compile(
    "[^\x00-\x1b\x20-\u036f\u0400-\u04ff\u2010-\u2027\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"
)
_SPACE_RUN = re.compile(r"\s\s")
#: The tokenizer's own pattern, for texts without two white space characters in a row: there its
#: look-ahead has nothing to decide, and without one the pattern runs on a faster engine.
_SINGLE = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s"""


class ByteEncoder:
    """Encodes a text to little-endian 32-bit ids, as the tokenizers library does.

    The rank file holds the same vocabulary for a faster library; special tokens in a text and
    unusual characters go the slower way.
    """

    def __init__(self, json_path: str, rank_path: str):
        self.whole = tokenizer(json_path)
        self.plain = ranked(rank_path, _SINGLE).encode_ordinary
        self.spaced = ranked(rank_path, public_tokenizers.PATTERN).encode_ordinary

    def encode(self, text: str) -> bytes:
        if _SPECIAL in text or _UNUSUAL.search(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = (self.spaced if _SPACE_RUN.search(text) else self.plain)(text)
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()


def cut(length: int, capacity: int = CAPACITY) -> list[int]:
    """Bounds of the pieces of a document: the short one first, the others full."""
    rest = length % capacity
    return [0, *range(rest or capacity, length + 1, capacity)]


def pieces(docs: DataFrame, with_ids: bool = False, vocabulary: str | None = None) -> DataFrame:
    """Tokenised pieces of all documents, with their place among those of one task and length."""
    base = vocabulary or VOCABULARY
    paths = (public_tokenizers.path(f"{base}.json"), public_tokenizers.path(f"{base}.tiktoken"))
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
        + ", ids binary" * with_ids
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("bytes", *paths), lambda: ByteEncoder(*paths))
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            doc_ids = batch.column("doc_id").to_pylist()
            for first in range(0, len(texts), 256):
                rows = []
                some = texts.slice(first, 256).to_pylist()
                for doc_id, text in zip(doc_ids[first : first + 256], some):
                    ids = encoder.encode(text) + b"\0\0\0\0"
                    bounds = cut(len(ids) // 4)
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        part = ids[4 * a : 4 * b]
                        row = (doc_id, k, a, b - a, zlib.crc32(part), task, seen[b - a])
                        rows.append(row + (part,) * with_ids)
                        seen[b - a] += 1
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                types = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(column, kind)
                        for column, kind in zip(zip(*rows), types + [pa.binary()] * with_ids)
                    ],
                    names=names + ["ids"] * with_ids,
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, split, schema)


Genome = dict[tuple[int, ...], int]


def fill_bins(counts: Mapping[int, int], rng: random.Random | None, capacity: int) -> Genome:
    """Pack all items, one pattern after the other, each as often as the counts allow.

    A pattern starts with the largest length left and takes the largest that fits until none
    does; with ``rng`` the second length is drawn at random.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    lengths = sorted(left)
    genome: Genome = {}
    while lengths:
        pattern, room, used = [], capacity, {}
        top = len(lengths)
        while True:
            top = bisect.bisect_right(lengths, room, 0, top)
            if top == 0:
                break
            pick = top - 1
            if rng and len(pattern) == 1:
                pick = rng.randrange(max(0, top - 64), top)
            n = lengths[pick]
            k = min(room // n, left[n] - used.get(n, 0)) if pattern or not rng else 1
            if k:
                pattern += [n] * k
                room -= n * k
                used[n] = used.get(n, 0) + k
            if pick == top - 1:
                top -= 1
            if not room:
                break
        times = min(left[n] // k for n, k in used.items())
        key = tuple(sorted(pattern, reverse=True))
        genome[key] = genome.get(key, 0) + times
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
                lengths.pop(bisect.bisect_left(lengths, n))
    return genome


def best_fit(genome: Genome, displaced: dict[int, int], capacity: int) -> Genome:
    """Put displaced items, longest first, into the fullest sequences with room, the rest in new ones."""
    room: dict[int, list] = {}
    for pattern, times in genome.items():
        slack = capacity - sum(pattern)
        if slack:
            room.setdefault(slack, []).append([pattern, times])
    slacks = sorted(room)
    out = {p: t for p, t in genome.items() if sum(p) == capacity}
    rest: dict[int, int] = {}
    for n in sorted(displaced, reverse=True):
        left = displaced[n]
        while left:
            at = bisect.bisect_left(slacks, n)
            if at == len(slacks):
                rest[n] = left
                break
            slack = slacks[at]
            pattern, times = room[slack][-1]
            k = min(times, left)
            left -= k
            if k == times:
                room[slack].pop()
                if not room[slack]:
                    del room[slack]
                    slacks.pop(at)
            else:
                room[slack][-1][1] -= k
            grown = tuple(sorted((*pattern, n), reverse=True))
            if slack == n:
                out[grown] = out.get(grown, 0) + k
            else:
                if slack - n not in room:
                    room[slack - n] = []
                    bisect.insort(slacks, slack - n)
                room[slack - n].append([grown, k])
    for group in room.values():
        for pattern, times in group:
            out[pattern] = out.get(pattern, 0) + times
    for pattern, times in fill_bins(rest, None, capacity).items():
        out[pattern] = out.get(pattern, 0) + times
    return out


def crossover(
    host: Genome, donor: Genome, counts: Mapping[int, int], rng: random.Random, capacity: int
) -> Genome:
    """Inject some of the donor's well-filled sequences whole and repair the host around them."""
    filled = sorted(donor, key=lambda p: (capacity - sum(p), p))
    well = filled[: max(1, len(filled) // 2)]
    left = dict(counts)
    child: Genome = {}

    def take(pattern: tuple[int, ...], times: int) -> None:
        used = Counter(pattern)
        times = min(times, *(left[n] // k for n, k in used.items()))
        if times > 0:
            child[pattern] = child.get(pattern, 0) + times
            for n, k in used.items():
                left[n] -= k * times

    for pattern in well:
        if rng.random() < 0.5:
            take(pattern, donor[pattern])
    for pattern in sorted(host, key=lambda p: (capacity - sum(p), p)):
        take(pattern, host[pattern])
    return best_fit(child, {n: c for n, c in left.items() if c}, capacity)


def mutate(genome: Genome, rng: random.Random, capacity: int) -> Genome:
    """Break up the emptiest sequences and some others, and pack their items again."""
    by_slack = sorted(genome, key=lambda p: (sum(p), p))
    broken = set(by_slack[: max(1, len(by_slack) // 20)])
    broken |= {p for p in by_slack if rng.random() < 0.05}
    loose: Counter = Counter()
    for pattern in broken:
        for n in pattern:
            loose[n] += genome[pattern]
    kept = {p: t for p, t in genome.items() if p not in broken}
    if rng.random() < 0.5:
        for pattern, times in fill_bins(loose, rng, capacity).items():
            kept[pattern] = kept.get(pattern, 0) + times
        return kept
    return best_fit(kept, dict(loose), capacity)


def cost(genome: Genome, capacity: int) -> tuple[int, float]:
    """Sequences used, then how unevenly they are filled (uneven is better, as gaps gather)."""
    squares = sum(t * (sum(p) / capacity) ** 2 for p, t in genome.items())
    return sum(genome.values()), -squares


def evolve(
    counts: Mapping[int, int], genomes: list[Genome], seed: int, capacity: int
) -> list[Genome]:
    """Some generations of one island; the best genomes first."""
    rng = random.Random(seed)
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    genomes = genomes or [fill_bins(counts, None, capacity)]
    while len(genomes) < POPULATION:
        genomes.append(fill_bins(counts, rng, capacity))
    rank = lambda g: cost(g, capacity)
    genomes = sorted(genomes, key=rank)[:POPULATION]
    for _ in range(GENERATIONS):
        if rank(genomes[0])[0] == least:
            break
        host, donor = (min(rng.sample(genomes, 2), key=rank) for _ in range(2))
        child = crossover(host, donor, counts, rng, capacity)
        genomes = sorted([*genomes, child, mutate(child, rng, capacity)], key=rank)[:POPULATION]
    return genomes


def pack_lengths(spark, counts: Mapping[int, int], capacity: int = CAPACITY) -> Genome:
    """The best packing of so many items of each length that the islands find."""
    if not counts:
        return {}
    counts = {int(n): int(c) for n, c in counts.items()}

    def island(part: pd.DataFrame) -> pd.DataFrame:
        number, turn = int(part["island"].iloc[0]), int(part["turn"].iloc[0])
        genomes = [pickle.loads(g) for g in part.sort_values("place")["genome"] if g is not None]
        found = evolve(counts, genomes, 1_000 * turn + number, capacity)
        return pd.DataFrame(
            {
                "island": number,
                "turn": turn + 1,
                "place": range(len(found)),
                "genome": [pickle.dumps(g) for g in found],
                "bins": [cost(g, capacity)[0] for g in found],
                "squares": [cost(g, capacity)[1] for g in found],
            }
        )

    schema = "island int, turn int, place int, genome binary, bins long, squares double"
    state = spark.range(ISLANDS).select(
        F.col("id").cast("int").alias("island"),
        F.lit(0).alias("turn"),
        F.lit(0).alias("place"),
        F.lit(None).cast("binary").alias("genome"),
    )
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    for _ in range(ROUNDS):
        apart = state.repartitionByRange(ISLANDS, "island")
        state = settle(per_group(apart, ["island"], island, schema), "islands")
        if state.agg(F.min("bins")).first()[0] == least:
            break
        # the elite of each island moves on to the next one
        moved = state.where("place = 0").withColumn("island", (F.col("island") + 1) % ISLANDS)
        state = state.union(moved.withColumn("place", F.lit(-1)))
    best = state.orderBy("bins", "squares", "island", "place").select("genome").first()
    return pickle.loads(best["genome"])


def slots(genome: Genome) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first slot, first sequence, copies a sequence and offset, pattern by pattern."""
    table: dict[int, list] = {}
    taken: Counter = Counter()
    sequence = 0
    for pattern in sorted(genome, reverse=True):
        times, offset = genome[pattern], 0
        for n, k in sorted(Counter(pattern).items(), reverse=True):
            table.setdefault(n, []).append((taken[n], sequence, k, offset))
            taken[n] += k * times
            offset += n * k
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in table.items()}


def pack_documents(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and the offset there.

    ``with_ids`` adds the ids themselves, little-endian unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    items = settle(pieces(docs, with_ids), "pieces")
    counts = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = slots(pack_lengths(spark, counts))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        items.groupBy("length", "task")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .drop("n")
    )
    ranked_items = items.join(before, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                first, base, copies, shift = places[int(n)]
                at = np.searchsorted(first, rank[rows], "right") - 1
                nth = rank[rows] - first[at]
                sequence[rows] = base[at] + nth // copies[at]
                offset[rows] = shift[at] + nth % copies[at] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*columns, "sequence_id", "offset"],
            )

    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long"
        + ", ids binary" * with_ids
        + ", sequence_id long, offset long"
    )
    return map_arrow(ranked_items.select(*columns, "rank"), place, schema)
