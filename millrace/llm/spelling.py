"""Spelling variant grouping over an index of variable-length grams.

Dictionary: the frequent grams of the distinct words, pruned to those that hold more than one in
``SHARE`` of all grams of their length, so it has at most ``SHARE`` grams a length. A gram is read on
while it is in the dictionary and ends with the first character that makes it rare (or at
``LONGEST``): common stretches give long grams, rare ones short grams. Where a gram ends depends on
its own characters alone, so an edit changes no gram that ends before it.

Every word is decomposed from its begin and from its end. The affected-gram bound of an edit at one
place is the last boundary before it and the first after it: all grams outside them stay. So two
words that are one edit apart agree in the begin and the end that these bounds leave, and the list of
that begin and end holds both. A word has as many lists as it has different bounds, about six.
Lists are merged by one shuffle; inside a list, words are verified by the exact rest at every place
the list stands for. A pair is found at one place only, the first where the two words differ.

A list longer than ``LIST`` words is not merged in one task: its words go on to the lists of single
places (the word without the character there), which hold at most one word per character of the
alphabet, however hot the long list was.

Cases: NULL and empty texts have no words; a row without ``doc_id`` keeps its runs whole. Repeated
rows count as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_arrow, settle
from millrace.llm.textscan import LOWER, flags, run_hashes, text_slices

SHORTEST_WORD, LEAST_COUNT, FORM_RATIO, DAMAGE = 7, 2, 10, 31
SHARE, LONGEST, LIST = 1000, 4, 4096
_HELD = 200_000
_LETTER = flags(bytes(range(65, 91)) + bytes(range(97, 123)))
_LEAD = 0xC3  # À to ÿ are this byte and any continuation byte
_CRC = np.zeros(256, np.uint32)
for _i in range(256):
    _c = _i
    for _ in range(8):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _CRC[_i] = _c


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end of every maximal run of letters."""
    lead = data == _LEAD
    after_lead = np.concatenate(([False], lead[:-1]))
    inside = _LETTER[data] | lead | after_lead
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~edge[1:])) + 1
    return np.searchsorted(offsets, begin, "right") - 1, begin, end


def _crcs(state: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes, carried on from the state of what stands before it."""
    length = end - begin
    order = np.argsort(-length, kind="stable")
    crc, start = state[order], begin[order]
    active = len(order) - np.searchsorted(np.sort(length), np.arange(length.max(initial=0)), "right")
    for k, m in enumerate(active):
        some = crc[:m]
        crc[:m] = _CRC[(some ^ data[start[:m] + k]) & 0xFF] ^ (some >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def slice_words(data: np.ndarray, offsets: np.ndarray, doc_ids: list) -> Counter:
    """Words of some texts, after damage, with their counts; words that are too short are left out."""
    found: Counter = Counter()
    data = LOWER[data]
    row, begin, end = _runs(data, offsets)
    continued = np.concatenate(([0], np.cumsum((data & 0xC0) == 0x80)))
    points = end - begin - (continued[end] - continued[begin])
    long = points >= SHORTEST_WORD
    row, begin, end, points = row[long], begin[long], end[long], points[long]
    if not len(row):
        return found
    first = [0 if i is None else zlib.crc32(f"{i}:".encode()) ^ 0xFFFFFFFF for i in doc_ids]
    known = np.array([i is not None for i in doc_ids])
    crc = _crcs(np.array(first, np.uint32)[row], data, begin, end)
    damaged = (crc % DAMAGE == 0) & known[row]
    raw = data.tobytes()
    for k in np.flatnonzero(damaged & (points > SHORTEST_WORD)).tolist():
        run = raw[begin[k] : end[k]].decode()
        at = int(crc[k]) % len(run)
        found[run[:at] + run[at + 1 :]] += 1
    begin, end = begin[~damaged], end[~damaged]
    if len(begin):
        lengths = end - begin
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        at = np.arange(lengths.sum()) - np.repeat(starts - begin, lengths)
        _, one, count = np.unique(
            run_hashes(data, at, starts, lengths), return_index=True, return_counts=True
        )
        for b, e, n in zip(begin[one].tolist(), end[one].tolist(), count.tolist()):
            found[raw[b:e].decode()] += n
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """Every word with its number of occurrences in all texts, from ``LEAST_COUNT`` on."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, data, offsets in text_slices(batch.column("text")):
                held.update(slice_words(data, offsets, doc_ids[first : first + len(offsets) - 1]))
                if len(held) > _HELD:
                    yield _counted(held, "word")
                    held = Counter()
        yield _counted(held, "word")

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = map_arrow(slim, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _counted(held: Counter, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
        names=[name, "n"],
    )


def gram_dictionary(words: DataFrame, share: int = SHARE, longest: int = LONGEST) -> frozenset[str]:
    """The grams that are read on: those above one in ``share`` of their length; fewer than
    ``share * (longest - 1)`` in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for size in range(1, longest):
                    held.update([word[i : i + size] for i in range(len(word) - size + 1)])
                if len(held) > _HELD:
                    yield _counted(held, "gram")
                    held = Counter()
        yield _counted(held, "gram")

    grams = map_arrow(words.select("word"), count, "gram string, n long")
    grams = grams.groupBy("gram").agg(F.sum("n").alias("n"), F.length("gram").alias("size"))
    total = grams.groupBy("size").agg(F.sum("n").alias("total"))
    frequent = grams.join(F.broadcast(total), "size").where(F.col("n") * share > F.col("total"))
    return frozenset(r["gram"] for r in frequent.select("gram").collect())


def boundaries(word: str, grams: frozenset[str], longest: int = LONGEST) -> tuple[list, list]:
    """Ends of the grams read from the begin, and begins of those read from the end, ascending.

    A gram that the word's end cuts off has no boundary: a longer word might read it on.
    """
    n, forward, backward, at = len(word), [0], [len(word)], 0
    while True:
        end = at + 1
        while end <= n and end - at < longest and word[at:end] in grams:
            end += 1
        if end > n:
            break
        forward.append(end)
        at = end
    at = n
    while True:
        begin = at - 1
        while begin >= 0 and at - begin < longest and word[begin:at] in grams:
            begin -= 1
        if begin < 0:
            break
        backward.append(begin)
        at = begin
    return forward, backward[::-1]


def affected(word: str, grams: frozenset[str], longest: int = LONGEST) -> list[tuple]:
    """The affected-gram bounds (a, b) of all edits of a word, each with the places it stands for.

    Places: characters ``lo`` to ``hi`` that may be replaced or deleted, gaps ``gap_lo`` to ``gap_hi``
    that may take another character (ends excluded). Every place is in exactly one bound.
    """
    n = len(word)
    forward, backward = boundaries(word, grams, longest)
    out = []
    for i, a in enumerate(forward):
        a_next = forward[i + 1] if i + 1 < len(forward) else n + 1
        for j, b in enumerate(backward):
            b_last = backward[j - 1] if j else -1
            lo, hi = max(a, b_last), min(a_next, b)
            gap_lo, gap_hi = max(a, b_last + 1), min(a_next, b + 1)
            if lo < hi or gap_lo < gap_hi:
                out.append((a, b, lo, max(lo, hi), gap_lo, max(gap_lo, gap_hi)))
    return out


def verified(members: list[tuple]) -> dict[str, list]:
    """Near words of one list: word to [number, count of the best, the best].

    ``members``: word, n, lo, hi, gap_lo, gap_hi. At each place the words are brought together by all
    their other characters; words with a character there differ in it alone, and the word that has
    none there is one insertion away from those that don't read the same up to a later place.
    """
    rests: dict[tuple, list] = {}
    for word, n, lo, hi, gap_lo, gap_hi in members:
        for x in range(lo, hi):
            rests.setdefault((x, word[:x], word[x + 1 :]), [[], None])[0].append((-n, word))
        for x in range(gap_lo, gap_hi):
            rests.setdefault((x, word[:x], word[x:]), [[], None])[1] = (-n, word)
    found: dict[str, list] = {}

    def meet(word: str, number: int, best: tuple) -> None:
        held = found.setdefault(word, [0, best])
        held[0] += number
        held[1] = min(held[1], best)

    for (x, _, _), (same, shorter) in rests.items():
        if len(same) > 1:
            same.sort()
            for k, (_, word) in enumerate(same):
                meet(word, len(same) - 1, same[1] if k == 0 else same[0])
        if shorter and same:
            short = shorter[1]
            longer = [s for s in same if x == len(short) or s[1][x] != short[x]]
            if longer:
                meet(short, len(longer), min(longer))
                for _, word in longer:
                    meet(word, 1, shorter)
    return found


def near_words(words: DataFrame, list_rows: int = LIST) -> DataFrame:
    """Per word that has any: ``n_near``, and ``best`` of ``n`` and ``word`` (the smallest of ties)."""
    grams = gram_dictionary(words)

    def decompose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n", "a", "b", "lo", "hi", "gap_lo", "gap_hi"]
        kinds = [pa.string(), pa.int64()] + [pa.int32()] * 6
        for batch in batches:
            rows = [
                (word, n, *bound)
                for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())
                for bound in affected(word, grams)
            ]
            columns = zip(*rows) if rows else [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names
            )

    ranges = "a int, b int, lo int, hi int, gap_lo int, gap_hi int"
    listed = map_arrow(words, decompose, f"word string, n long, {ranges}")
    listed = listed.withColumn("key", F.expr("xxhash64(-1, left(word, a), substr(word, b + 1))"))
    listed = settle(listed.drop("a", "b"), "gram-lists")
    long = listed.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > list_rows)
    split = listed.join(long, "key", "left")
    short = split.where("size is null").drop("size")
    places = split.where("size is not null").drop("size", "key")
    single = places.select(
        "*", F.explode(F.expr("if(lo < hi, sequence(lo, hi - 1), array())")).alias("x")
    ).select(
        "word", "n", F.col("x").alias("lo"), (F.col("x") + 1).alias("hi"),
        F.lit(0).alias("gap_lo"), F.lit(0).alias("gap_hi"),
        F.expr("xxhash64(x, left(word, x), substr(word, x + 2))").alias("key"),
    )
    gaps = places.select(
        "*", F.explode(F.expr("if(gap_lo < gap_hi, sequence(gap_lo, gap_hi - 1), array())")).alias("x")
    ).select(
        "word", "n", F.lit(0).alias("lo"), F.lit(0).alias("hi"),
        F.col("x").alias("gap_lo"), (F.col("x") + 1).alias("gap_hi"),
        F.expr("xxhash64(x, left(word, x), substr(word, x + 1))").alias("key"),
    )
    lists = short.unionByName(single).unionByName(gaps)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n_near", "best_n", "best_word"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        members, last, rows = [], None, []

        def close():
            if len(members) > 1:
                for word, (number, (minus, best)) in verified(members).items():
                    rows.append((word, number, -minus, best))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("word", "n", "lo", "hi", "gap_lo", "gap_hi")]
            for key, row in zip(batch.column("key").to_pylist(), zip(*columns)):
                if key != last:
                    close()
                    members, last = [], key
                members.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows.clear()
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    merged = lists.repartition("key").sortWithinPartitions("key")
    found = map_arrow(merged, merge, "word string, n_near long, best_n long, best_word string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best_word").alias("word")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", (-F.col("best.minus")).alias("best_n"), F.col("best.word").alias("best_word"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """Follow ``form`` from every word to the last: columns ``word`` and ``root``.

    A form is ``FORM_RATIO`` times as frequent as its word, so chains are short; each step doubles
    the way a word has gone.
    """
    state = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = settle(
            state.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        if state.where("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Every word with its number of near words, its more frequent form and the root of its forms."""
    words = settle(word_counts(docs), "words")
    judged = settle(
        words.join(near_words(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.expr(f"if(best_n >= {FORM_RATIO} * n, best_word, null)").alias("form"),
            F.expr(f"if(best_n >= {FORM_RATIO} * n, best_n, null)").alias("form_n"),
        ),
        "near-words",
    )
    followed = roots(judged.where("form is not null"))
    return judged.join(followed, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
