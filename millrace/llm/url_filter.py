"""URL verdicts by rules and, elsewhere, by the words that host and path are made of.

A rule names a host and the beginning of a path and holds for the host's subdomains; the longest
one that fits decides. The remaining URLs are scored: every host label is split into words by the
Viterbi path of a unigram model, and multinomial naive Bayes weighs the words of host and path. The
unigram counts come from the words of all pages; the class counts from all URLs that a rule decides.

Nothing is broadcast but the rules. Labels are split once per distinct label, each in a task with
just the counts of its own substrings, which a join brings there. Token counts are combined before
the shuffle, and the join of tokens with their weights is left to Spark's skew handling.

Cases: a NULL URL or one without ``://`` has an empty host and path and no tokens; without tokens
the prior decides. If the rules decide no URL, everything else is allowed; equal scores allow.
Repeated rows are judged each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import by_task, map_arrow, settle
from millrace.operators.sizing import broadcast_if_small, with_position

#: verdict, host, beginning of the path
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LONGEST_WORD = 24
SMOOTHING = 1.0
_WORD = re.compile("[a-z]+")


def host_of(url: str = "url") -> Column:
    rest = F.split_part(F.col(url), F.lit("://"), F.lit(2))
    after = F.regexp_replace(F.col(url), r"(?s)^.*?://", "")
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    known = F.col(url).contains("://") & rest.isNotNull()
    return F.coalesce(F.when(known, lowered), F.lit(""))


def path_of(url: str = "url") -> Column:
    after = F.regexp_replace(F.col(url), r"(?s)^.*?://", "")
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(F.col(url).contains("://"), path), F.lit(""))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits ``host`` and ``path``."""
    rule = verdict = None
    for kind, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col(
            "path"
        ).startswith(path)
        if rule is None:
            rule, verdict = F.when(fits, host + path), F.when(fits, kind)
        else:
            rule, verdict = rule.when(fits, host + path), verdict.when(fits, kind)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """How often each lower-case word occurs in the pages; counted per task, then together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: Counter = Counter()
            for html in batch.column(0).to_pylist():
                if html:
                    words.update(_WORD.findall(html.lower()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                names=["word", "n"],
            )

    parts = map_arrow(pages.select("html"), count, "word string, n long")
    return (
        parts.where(F.length("word") <= LONGEST_WORD).groupBy("word").agg(F.sum("n").alias("n"))
    )


def viterbi(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable split into words; an unseen word costs more with every letter.

    Of equally probable splits the one with the longer last word is taken.
    """
    best, back = [0.0], [0]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            word = label[start:end]
            seen = counts.get(word, 0)
            score = math.log(seen / total) if seen else math.log(10 / total) - len(word) * math.log(10)
            options.append((best[start] + score, -start))
        score, start = max(options)
        best.append(score)
        back.append(-start)
    words, end = [], len(label)
    while end:
        words.append(label[back[end] : end])
        end = back[end]
    return words[::-1]


def segment_labels(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """The words of every distinct ``label`` of letters."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    starts = F.explode(F.sequence(F.lit(1), F.length("label"))).alias("start")
    spans = labels.select("label", starts).select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("start") + 1)),
                lambda n: F.substring(F.col("label"), F.col("start"), n),
            )
        ).alias("word"),
    )
    found = spans.distinct().join(counts, "word", "left")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a label are adjacent; its known words are held until the next one."""
        label, seen, done = None, {}, []
        for batch in batches:
            columns = (batch.column(name).to_pylist() for name in ("label", "word", "n"))
            for here, word, n in zip(*columns):
                if here != label:
                    if label is not None:
                        done.append((label, viterbi(label, seen, total)))
                    label, seen = here, {}
                if n is not None:
                    seen[word] = n
            yield segmented(done)
            done = []
        if label is not None:
            yield segmented([(label, viterbi(label, seen, total))])

    def segmented(done: list) -> pa.RecordBatch:
        arrays = [
            pa.array([label for label, _ in done], pa.string()),
            pa.array([words for _, words in done], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["label", "words"])

    tasked = found.withColumn("task", F.xxhash64("label"))
    return by_task(tasked, "label", split, "label string, words array<string>")


def _letters(column: Column) -> Column:
    return F.regexp_extract_all(column, F.lit("([a-z]+|[0-9]+|[^\\x00-\\x7f]+)"), F.lit(1))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    rule, verdict = rule_columns(rules)
    placed = with_position(pages.select(F.col("page_id").cast("long").alias("page_id"), "url"), "row")
    judged = settle(
        placed.withColumn("host", host_of()).withColumn("path", path_of())
        .select("row", "page_id", "host", "path", rule.alias("rule"), verdict.alias("decided")),
        "judged",
    )
    # split each distinct host once
    hosts = judged.where("host <> ''").select("host").distinct()
    pieces = hosts.select("host", F.posexplode(_letters(F.col("host"))).alias("at", "label"))
    labels = pieces.select("label").where("label RLIKE '^[a-z]+$'").distinct()
    words = segment_labels(labels, settle(word_counts(pages), "words"))
    host_tokens = settle(
        pieces.join(words, "label", "left").select(
            "host", F.explode(F.coalesce("words", F.array("label"))).alias("token")
        ),
        "host-tokens",
    )
    lowered = F.translate("path", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # digits say how long they are, not what they are
    shape = lambda t: F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(t))).otherwise(t)
    path_tokens = judged.select(
        "row", "decided", F.explode(F.transform(_letters(lowered), shape)).alias("token")
    )
    # documents of one host share its tokens: weigh the host once instead of each of its pages
    host_classes = judged.groupBy("host").agg(
        F.count(F.when(F.col("decided") == "allow", 1)).alias("allow"),
        F.count(F.when(F.col("decided") == "block", 1)).alias("block"),
    )
    counted = (
        host_tokens.join(host_classes, "host")
        .select("token", "allow", "block")
        .union(
            path_tokens.where("decided IS NOT NULL").select(
                "token",
                F.when(F.col("decided") == "allow", 1).otherwise(0),
                F.when(F.col("decided") == "block", 1).otherwise(0),
            )
        )
        .groupBy("token")
        .agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        .where("allow + block > 0")
    )
    counted = settle(counted, "tokens")
    sums = counted.agg(F.sum("allow"), F.sum("block"), F.count("*")).first()
    prior = host_classes.agg(F.sum("allow"), F.sum("block")).first()
    allowed, blocked, vocabulary = sums[0] or 0, sums[1] or 0, sums[2]
    start = math.log(((prior[1] or 0) + SMOOTHING) / ((prior[0] or 0) + SMOOTHING))
    if not (prior[0] or 0) + (prior[1] or 0):
        start = 0.0
    size = SMOOTHING * max(vocabulary, 1)
    weight = F.log((F.col("block") + SMOOTHING) / (blocked + size)) - F.log(
        (F.col("allow") + SMOOTHING) / (allowed + size)
    )
    weights = settle(counted.select("token", weight.alias("weight")), "weights")
    of_host = (
        host_tokens.join(weights, "token").groupBy("host").agg(F.sum("weight").alias("host_score"))
    )
    of_path = (
        path_tokens.where("decided IS NULL")
        .join(weights, "token")
        .groupBy("row")
        .agg(F.sum("weight").alias("path_score"))
    )
    score = F.lit(start) + F.coalesce("host_score", F.lit(0.0)) + F.coalesce("path_score", F.lit(0.0))
    # where the hosts are few, a common one need not gather its pages in a task; where they are many,
    # the skewed keys of the sort-merge join are split
    of_host = broadcast_if_small(settle(of_host, "host-scores"))
    return (
        judged.join(of_host, "host", "left")
        .join(of_path, "row", "left")
        .withColumn("score", F.round(score, 9))
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("decided", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
            F.when(F.col("decided").isNull(), F.col("score")).alias("score"),
        )
    )
