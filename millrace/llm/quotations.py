"""Quoted passages of messages, linked to the messages they come from.

A line's quote level is the number of ``>`` marks it starts with. Consecutive lines of one level
form a passage, normalised by lower case and single blanks. Each message offers its own words to be
quoted: the whole, each paragraph, line and sentence, by hash. A quoted passage (or, where it was cut
or wrapped otherwise, its own paragraphs, lines and sentences) is joined by conversation and hash to
the message that wrote it first. The latest such original of its level-one quotes is the message it
replies to.

A conversation is ordered by replies: threads by the turn of their first message, messages of a
thread by turn, so an original always comes before its replies. Quoted lines are left out.

Scale: originals are a grouped minimum, combined before the shuffle; threads are found by doubling
the reply links, in as many rounds as the logarithm of the longest chain; places are counted over
ranges of the sorted table, so a conversation that holds a large part of all rows is spread.

Cases: NULL text has no quotes and stays NULL. Rows without ``conv_id`` or ``turn`` are linked with
nothing. Rows that repeat a turn count as one message with the words of all. Ties of place follow
the role and text. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.common import map_arrow, settle

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_GAP = re.compile(r"\n[ \t\r]*\n")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


def key(passage: str) -> int | None:
    """Hash of a normalised passage; None without words."""
    words = " ".join(passage.lower().split())
    return xxhash.xxh64_intdigest(words) - (1 << 63) if words else None


def parse(text: str) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes, and its quoted passages with their levels, in order."""
    if ">" not in text:
        return text, []
    own: list[str] = []
    quotes: list[tuple[int, list[str]]] = []
    before = 0
    for line in text.split("\n"):
        marks = _MARKS.match(line)
        level = marks[1].count(">") if marks else 0
        if not level:
            own.append(line)
        elif level == before:
            quotes[-1][1].append(line[marks.end() :])
        else:
            quotes.append((level, [line[marks.end() :]]))
        before = level
    if not quotes:
        return text, []
    return "\n".join(own).strip("\n"), [(level, "\n".join(lines)) for level, lines in quotes]


def keys_of(text: str) -> set[int]:
    """Hashes of the whole text, its paragraphs, lines and sentences; sentences survive new line breaks."""
    paragraphs = _GAP.split(text)
    sentences = (s for paragraph in paragraphs for s in _SENTENCE_END.split(paragraph))
    parts = {text, *paragraphs, *text.split("\n"), *sentences}
    return {k for k in map(key, parts) if k is not None}


_PARSED = (
    "conv_id long, turn long, role string, text string, own array<long>, "
    "quotes array<struct<level:int,whole:long,parts:array<long>>>"
)


def _parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    quote = pa.struct([("level", pa.int32()), ("whole", pa.int64()), ("parts", pa.list_(pa.int64()))])
    for batch in batches:
        texts, owns, quoted = [], [], []
        for text in batch.column("text").to_pylist():
            rest, quotes = parse(text or "")
            texts.append(None if text is None else rest)
            owns.append(sorted(keys_of(rest)))
            quoted.append(
                [
                    {
                        "level": level,
                        "whole": key(passage),
                        "parts": sorted(keys_of(passage)),
                    }
                    for level, passage in quotes
                    if passage.strip()
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "turn", "role")),
                pa.array(texts, pa.string()),
                pa.array(owns, pa.list_(pa.int64())),
                pa.array(quoted, pa.list_(quote)),
            ],
            names=["conv_id", "turn", "role", "text", "own", "quotes"],
        )


def find_links(parsed: DataFrame) -> DataFrame:
    """Every quoted passage with the turn of its original, or NULL: a row per passage."""
    known = parsed.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    originals = (
        known.select("conv_id", "turn", F.explode("own").alias("hash"))
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("original"))
    )
    passages = known.where(F.size("quotes") > 0).select(
        "conv_id", "turn", F.posexplode("quotes").alias("passage", "quote")
    )
    # the whole passage first, then its parts
    tried = passages.select(
        "conv_id",
        "turn",
        "passage",
        F.col("quote.level").alias("level"),
        F.posexplode(
            F.array_distinct(F.concat(F.array("quote.whole"), F.col("quote.parts")))
        ).alias("part", "hash"),
    )
    found = tried.join(originals, ["conv_id", "hash"], "left").withColumn(
        "original", F.when(F.col("original") < F.col("turn"), F.col("original"))
    )
    return found.groupBy("conv_id", "turn", "passage", "level").agg(
        F.coalesce(F.max(F.when(F.col("part") == 0, F.col("original"))), F.max("original")).alias(
            "original"
        )
    )


def threads(replies: DataFrame) -> DataFrame:
    """Root and depth of every replying message, from its ``reply_to``; by doubling the links."""
    state = settle(
        replies.select("conv_id", "turn", F.col("reply_to").alias("root"), F.lit(1).cast("long").alias("depth")),
        "replies",
    )
    while True:
        on = state.select(
            "conv_id",
            F.col("turn").alias("root"),
            F.col("root").alias("above"),
            F.col("depth").alias("more"),
        )
        grown = state.join(on, ["conv_id", "root"], "left")
        if not grown.where("above IS NOT NULL").take(1):
            return state
        state = settle(
            grown.select(
                "conv_id",
                "turn",
                F.coalesce("above", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "replies",
        )


def with_place(df: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``by`` value in ``order``, from 0, also where one value is huge."""
    spread = df.repartitionByRange(by, *order).withColumn("__range", F.spark_partition_id())
    spread = settle(spread, "ranges")
    here = Window.partitionBy("__range", by).orderBy(*order)
    before = Window.partitionBy(by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        spread.groupBy(by, "__range")
        .agg(F.count("*").alias("__n"))
        .select(
            F.col(by).alias("__by"),
            F.col("__range").alias("__at"),
            F.coalesce(F.sum("__n").over(before.partitionBy(by)), F.lit(0)).alias("__before"),
        )
    )
    same = F.col(by).eqNullSafe(F.col("__by")) & (F.col("__range") == F.col("__at"))
    return (
        spread.withColumn("__nth", F.row_number().over(here) - 1)
        .join(counts, same)
        .withColumn(name, F.col("__nth") + F.col("__before"))
        .drop("__range", "__nth", "__by", "__at", "__before")
    )


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with its place in the reply-ordered conversation."""
    slim = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
    )
    parsed = settle(map_arrow(slim, _parse_batches, _PARSED), "parsed")
    links = settle(find_links(parsed), "links")
    per_turn = links.groupBy("conv_id", "turn").agg(
        F.count("original").alias("n_linked"),
        F.max(F.when(F.col("level") == 1, F.col("original"))).alias("reply_to"),
    )
    replies = per_turn.where("reply_to IS NOT NULL")
    rooted = threads(replies)
    joined = (
        parsed.select("conv_id", "turn", "role", "text", F.size("quotes").alias("n_quotes"))
        .join(per_turn, ["conv_id", "turn"], "left")
        .join(rooted, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            "text",
            "n_quotes",
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            "reply_to",
            F.coalesce("root", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).alias("depth"),
        )
    )
    return with_place(joined, "conv_id", ["thread", "turn", "role", "text"], "position")
