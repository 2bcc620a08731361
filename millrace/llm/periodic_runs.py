"""Maximal periodic runs of words, and texts with all but a run's first period taken out.

Scale-tiled: for each octave of periods, P to 2P-1, a document is covered by boundaries ``3P`` words
apart. A run of such a period has at least ``3P`` matches (words equal to the one a period later) in
a row, so one of them falls on a boundary, and the fragment around it shows up there: the Z-function
of the words from the boundary on gives how far the matches go forward, for all periods of the
octave at once, and the Z-function of the reversed words up to it how far they go back.

1. One scan reads words and looks at every boundary of every octave: a run that covers it repeats
   at least a short gram of words right before or after it, which hashes of word grams tell at once.
   Stretches of boundaries that do become tile rows: packed word numbers with ``3P`` words before
   the first boundary and ``5P`` after the last. Most documents have none.
2. Tiles are dealt to tasks one by one, whatever document they come from, and solved independently.
   A fragment that reaches the next boundary is a part of a longer one.
3. Fragments are shuffled by document and period and stitched to runs where they touch.
4. Runs are gathered by document, and only documents that have any are read again to be collapsed.

Documents whose period is a power of a shorter one are told by the same Z-function and left to the
octave of the shorter period, so every run is found once.

Cases: NULL, empty and blank texts have no words and no runs. A row without ``doc_id`` keeps its
words as they are. Repeated rows give a row each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import map_arrow, settle
from millrace.llm.textscan import mix, salted_by_row, scan_words, text_slices

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: Words of a tile row, unless a single boundary needs more; pairs looked at together in a scan.
TILE_WORDS, BLOCK = 1 << 15, 1 << 20
LONGEST_GRAM = 16
_TILE = "row long, octave int, base long, first int, boundaries int, size int, tile binary"
_DOC = "doc_id long, n_words long, plain_sha256 string, words binary"


def replanted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Start and period of the periodic rest that the query plants in some documents."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    start = g % n
    return None if h % 10 else (start, 1 + (n - start) // (3 + g % 8))


def _octaves(longest: int) -> Iterator[int]:
    period = 1
    while longest >= max(LEAST_LENGTH, LEAST_EXPONENT * period):
        yield period
        period *= 2


def _gram(period: int) -> int:
    """Matches that a run has on one side of its boundary at least."""
    return 3 if period == 1 else min((3 * period + 1) // 2, LONGEST_GRAM)


def _grams(words: np.ndarray, sizes: set[int], room: int) -> dict[int, np.ndarray]:
    """Hashes of the word grams of each size from each word on, then ``room`` values of their own."""
    out, value = {}, words
    for k in range(1, max(sizes, default=0) + 1):
        if k > 1:
            value = mix(value[: len(words) - k + 1] + words[k - 1 :]) if len(words) >= k else value[:0]
        if k in sizes:
            own = mix(np.arange(len(words) - len(value) + room, dtype=np.uint64) + np.uint64(1 << 40))
            out[k] = np.concatenate((value, own))
    return out


def candidate_tiles(words: np.ndarray, starts: np.ndarray) -> Iterator[tuple]:
    """Stretches of boundaries that a run may cover: row, octave, base, first, boundaries, tile.

    ``words`` are hashes of the words of several rows, differing between rows; ``starts`` has the
    first word of each row and the end.
    """
    lengths = np.diff(starts)
    octaves = list(_octaves(int(lengths.max(initial=0))))
    grams = _grams(words, {_gram(p) for p in octaves}, 2 * (octaves[-1] if octaves else 0))
    for period in octaves:
        size = _gram(period)
        gram = grams[size]
        rows = np.flatnonzero(lengths >= max(LEAST_LENGTH, LEAST_EXPONENT * period))
        per_row = (lengths[rows] - 1 - period) // (3 * period) + 1
        row = np.repeat(rows, per_row)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        local = nth * 3 * period
        at, end = starts[row] + local, starts[row + 1]
        hit = np.zeros(len(row), bool)
        step = max(1, BLOCK // period)
        for first in range(0, len(row), step):
            some = slice(first, first + step)
            here, back = at[some], np.maximum(at[some] - size, 0)
            other = here[:, None] + np.arange(period, 2 * period)
            same = gram[other] == gram[here][:, None]
            before = gram[other - size + np.maximum(size - here, 0)[:, None]] == gram[back][:, None]
            same |= before & (local[some] >= size)[:, None]
            same &= other < end[some][:, None]
            hit[some] = same.any(axis=1)
        found = np.flatnonzero(hit)
        if not len(found):
            continue
        apart = (np.diff(found) != 1) | (np.diff(row[found]) != 0)
        stretch = np.concatenate(([0], np.cumsum(apart)))
        since = np.arange(len(found)) - np.searchsorted(stretch, stretch)
        piece = since // max(1, TILE_WORDS // (3 * period))
        cut = np.flatnonzero(np.diff(stretch) | np.diff(piece)) + 1
        for part in np.split(found, cut):
            r = int(row[part[0]])
            low = max(0, int(local[part[0]]) - 3 * period)
            high = min(int(lengths[r]), int(local[part[-1]]) + 5 * period)
            tile = words[starts[r] + low : starts[r] + high]
            yield r, period, low, int(local[part[0]]) - low, len(part), tile


def z_function(s: list) -> list[int]:
    """For each place, how many items from there on equal those from the begin on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right or k == right - i:
            while i + k < n and s[k] == s[i + k]:
                k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    if n:
        z[0] = n
    return z


@lru_cache(maxsize=1 << 16)
def prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def solve_tile(tile: list, period: int, first: int, boundaries: int) -> list[tuple]:
    """Match fragments (period, begin, end) around the boundaries of one tile."""
    open_: dict[int, list] = {}
    out = []
    for at in range(first, first + 3 * period * boundaries, 3 * period):
        ahead = z_function(tile[at : at + 5 * period])
        low, high = max(0, at - 3 * period), min(len(tile), at + 2 * period)
        behind = z_function(tile[low:at][::-1] + [-1] + tile[low:high][::-1])
        for p in range(period, min(2 * period, len(ahead))):
            forward = ahead[p]
            if not forward:
                continue
            back = behind[at - low + 1 + high - at - p] if at > low and at + p <= high else 0
            least = max(LEAST_LENGTH - p, (LEAST_EXPONENT - 1) * p)
            whole = forward + back >= least
            if not (whole or forward >= 3 * period or back >= 3 * period):
                continue
            if any(ahead[p // r] >= p - p // r for r in prime_factors(p)):
                continue  # a power of a shorter period
            held = open_.get(p)
            if held and at - back <= held[1]:
                held[1] = max(held[1], at + forward)
            else:
                if held:
                    out.append((p, *held))
                open_[p] = [at - back, at + forward]
    return out + [(p, *held) for p, held in open_.items()]


def scan_documents(docs: DataFrame) -> DataFrame:
    """Document rows (words joined by blanks kept where a tile asks for them) and tile rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(3)
        names = [part.split()[0] for part in f"{_TILE}, {_DOC}".split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.int32()] * 3, pa.binary()]
        kinds += [pa.int64(), pa.int64(), pa.string(), pa.binary()]
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in text_slices(batch.column("text")):
                n_rows = len(offsets) - 1
                words = scan_words(data, offsets)
                starts = np.concatenate(([0], np.cumsum(words.per_row(n_rows))))
                order = np.arange(len(words.hash))
                for k in range(n_rows):
                    a, b = int(starts[k]), int(starts[k + 1])
                    planted = replanted(doc_ids[first + k], b - a)
                    if planted:
                        order[a + planted[0] : b] = a + planted[0] + np.arange(b - a - planted[0]) % planted[1]
                joined, ends = _join(data, words.begin[order], words.end[order])
                hashes = salted_by_row(words.hash[order], words.row)
                rows, wanted = [], set()
                for r, period, base, boundary, count, tile in candidate_tiles(hashes, starts):
                    wanted.add(r)
                    numbers = np.unique(tile, return_inverse=True)[1].astype("<u4").tobytes()
                    rows.append((key + r, period, base, boundary, count, len(tile), packer.compress(numbers), *[None] * 4))
                    if len(rows) >= 1000:
                        yield _batch(rows, kinds, names)
                        rows = []
                for k in range(n_rows):
                    a, b = int(starts[k]), int(starts[k + 1])
                    text = joined[ends[a] : ends[b] - 1] if b > a else b""
                    sha = hashlib.sha256(text).hexdigest()
                    rows.append((key + k, *[None] * 6, doc_ids[first + k], b - a, sha, text if k in wanted else None))
                yield _batch(rows, kinds, names)
                key += n_rows

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, scan, f"{_TILE}, {_DOC}")


def _batch(rows: list, kinds: list, names: list) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _join(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Runs of bytes one after the other, each with a blank behind it, and where each starts."""
    lengths = end - begin + 1
    ends = np.concatenate(([0], np.cumsum(lengths)))
    if not len(begin):
        return b"", ends
    at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], lengths)
    out = data[np.minimum(at, len(data) - 1)]
    out[ends[1:] - 1] = 0x20
    return out.tobytes(), ends


def solved(tiles: DataFrame) -> DataFrame:
    """Match fragments of all tiles: ``row``, ``period``, ``begin`` and ``end`` in the document."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                row, octave, base, first, count, size, tile = (c[k].as_py() for c in batch.columns)
                numbers = np.frombuffer(unpacker.decompress(tile, 4 * size), "<u4").tolist()
                rows = [(row, p, base + s, base + e) for p, s, e in solve_tile(numbers, octave, first, count)]
                yield _batch(rows, [pa.int64()] * 4, ["row", "period", "begin", "end"])

    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = tiles.repartition(tasks, "row", "octave", "base")
    return map_arrow(dealt, solve, "row long, period long, begin long, end long")


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs from touching fragments of a document and period: ``row``, ``start``, ``length``, ``period``."""
    order = Window.partitionBy("row", "period").orderBy("begin", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = (F.col("reach").isNull() | (F.col("begin") > F.col("reach"))).cast("int")
    islands = fragments.withColumn("reach", reach).withColumn("new", new)
    islands = islands.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        islands.groupBy("row", "period", "island")
        .agg(F.min("begin").alias("start"), F.max("end").alias("end"))
        .select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
        .where(f"length >= greatest({LEAST_LENGTH}, {LEAST_EXPONENT} * period)")
    )


def collapsed(documents: DataFrame) -> DataFrame:
    """Digest of the kept words of documents with ``words`` and ``dropped`` intervals of word numbers."""

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                words = batch.column("words")[k].as_py().split(b" ")
                change = np.zeros(len(words) + 1, np.int64)
                for cut in batch.column("dropped")[k].as_py():
                    change[cut["begin"]] += 1
                    change[cut["end"]] -= 1
                kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
                text = b" ".join([words[i] for i in kept])
                rows.append((batch.column("row")[k].as_py(), hashlib.sha256(text).hexdigest()))
            yield _batch(rows, [pa.int64(), pa.string()], ["row", "collapsed_sha256"])

    return map_arrow(documents.select("row", "words", "dropped"), collapse, "row long, collapsed_sha256 string")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document its number of runs, the one of largest exponent, and digests of all runs and of
    the words that stay when every run is cut to its first period."""
    scanned = settle(scan_documents(docs), "run-tiles")
    documents = scanned.where("octave is null")
    tiles = scanned.where("octave is not null").select(*[part.split()[0] for part in _TILE.split(", ")])
    runs = stitched(solved(tiles))
    # exponent as whole part and rest, then the smallest start and period
    rank = F.struct(
        F.expr("length div period").alias("whole"),
        (F.col("length") % F.col("period") / F.col("period")).alias("rest"),
        (-F.col("start")).alias("s"),
        (-F.col("period")).alias("p"),
        "length",
    )
    line = F.concat(F.concat_ws(",", "start", "length", "period"), F.lit("\n"))
    per_row = settle(
        runs.groupBy("row").agg(
            F.count("*").alias("n_runs"),
            F.max(rank).alias("best"),
            F.sort_array(F.collect_list(F.struct("start", "period", line.alias("line")))).alias("runs"),
            F.collect_list(
                F.struct((F.col("start") + F.col("period")).alias("begin"), (F.col("start") + F.col("length")).alias("end"))
            ).alias("dropped"),
        ).select(
            "row",
            "n_runs",
            (-F.col("best.s")).alias("start"),
            F.col("best.length").alias("length"),
            (-F.col("best.p")).alias("period"),
            F.sha2(F.array_join(F.col("runs.line"), ""), 256).alias("runs_sha256"),
            "dropped",
        ),
        "runs",
    )
    texts = collapsed(documents.where("words is not null").select("row", "words").join(per_row, "row"))
    found = per_row.drop("dropped").join(texts, "row")
    return documents.select("row", "doc_id", "plain_sha256").join(found, "row", "left").select(
        "doc_id",
        F.coalesce("n_runs", F.lit(0)).cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.coalesce("runs_sha256", F.sha2(F.lit(""), 256)).alias("runs_sha256"),
        F.coalesce("collapsed_sha256", "plain_sha256").alias("collapsed_sha256"),
    )
