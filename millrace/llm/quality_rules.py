"""Document statistics, base rules, and rejection of robust multivariate outliers.

Every document becomes a vector of transformed statistics. For each language and source a minimum
covariance determinant estimate of centre and scatter is found by concentration steps over all
documents: measure distances, keep the nearest half, estimate again. The half is kept through every
step of both starts (one at the medians, one at the middles of the shortest halves), so junk must
outnumber the rest of a group to carry an estimate; only the last, reweighting step widens it. A
document whose Mahalanobis distance from the final estimate is beyond a chi-square bound is rejected.

Spark keeps the work distributed. One step is a join with the small estimates, a grouped sum of
moments per distance bin (combined before the shuffle), and a small calculation over the bins of a
group, whose number is bounded however many documents the group has.

Cases: NULL or blank text has zero counts and fails the base rule. NULL ``lang`` or ``source`` is a
value of its own. A cell below ``MIN_GROUP`` passing documents is judged by the estimate of all
passing documents of its language, those of large cells included, and a language below ``MIN_GROUP``
by that of all passing documents. Only if the whole table has fewer than ``MIN_TABLE`` is there no
verdict, and its documents are kept. Repeated rows are judged each.
Extra columns are ignored or passed through; none may start with ``__q``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.common import map_arrow, per_group, settle
from millrace.llm.textscan import (
    WORD,
    flags,
    mix,
    powers,
    repeated,
    row_sums,
    salted_by_row,
    scan_words,
    text_slices,
    windows,
    _BYTE,
)

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct",
    "n_upper",
    "n_punct",
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_GROUP = 100
#: Share of a group that a concentration step keeps (a half breaks down last), the tail beyond which
#: a document is rejected, and the words after which a statistic is taken at half its deviation.
CORE = 0.5
TAIL = 1e-6
REWEIGHT = 0.975
SETTLING_WORDS = 50
MAX_STEPS = 10
#: Transformed statistics with the least spread each is taken to have.
FLOORS = {
    "word_length": 0.06,
    "symbols": 0.03,
    "upper": 0.03,
    "punctuation": 0.04,
    "dup_lines": 0.10,
    "repeats": 0.12,
    "variety": 0.04,
}
DIMS = len(FLOORS)
#: Passing documents in a table from which any estimate is taken: five a dimension. With fewer, a
#: half-sample gives too small a scatter, and clean documents would go.
MIN_TABLE = 5 * DIMS
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
_GRID = 1024
_BINS = 64

_SYMBOL = flags(b"#*$%&|<>")
_UPPER = flags(bytes(range(65, 91)))
_PUNCT = flags(b"!\"'(),-./:;?@[\\]^_`{}~+=")


def count_slice(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of a text slice."""
    rows = len(offsets) - 1
    words = scan_words(data, offsets)
    out = {"n_words": words.per_row(rows)}
    out["word_chars"] = row_sums(words.inside & ((data & 0xC0) != 0x80), offsets)
    for name, chars in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_punct", _PUNCT)):
        out[name] = row_sums(chars[data], offsets)

    # words covered by a window that occurs twice in its row
    value, whole = windows(words, WINDOW)
    at = np.flatnonzero(whole)
    at = at[repeated(salted_by_row(value[at], words.row[at]))]
    cover = np.zeros(len(words.row) + WINDOW + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    covered = np.cumsum(cover)[: len(words.row)] > 0
    out["n_repeat_words"] = np.bincount(words.row[covered], minlength=rows)

    keys = salted_by_row(words.hash, words.row)
    order = np.argsort(keys)
    again = np.zeros(len(keys), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    out["n_distinct"] = np.bincount(words.row[~again], minlength=rows)

    # lines with a word, and those equal to an earlier one
    out["n_lines"] = out["n_dup_lines"] = np.zeros(rows, np.int64)
    if len(data):
        newline = data == 10
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins[1:] |= newline[:-1]
        starts = np.flatnonzero(begins)
        lengths = np.diff(np.append(starts, len(data)))
        place = np.arange(len(data)) - np.repeat(starts, lengths)
        values = _BYTE[data] * powers(int(lengths.max()))[place]
        values[newline] = 0
        length = lengths - newline[starts + lengths - 1]
        key = mix(np.add.reduceat(values, starts) + mix(length.astype(np.uint64)))
        full = np.add.reduceat(words.inside.astype(np.int64), starts) > 0
        row = np.searchsorted(offsets, starts[full], "right") - 1
        key = salted_by_row(key[full], row)
        order = np.argsort(key)
        again = key[order[1:]] == key[order[:-1]]
        out["n_lines"] = np.bincount(row, minlength=rows)
        out["n_dup_lines"] = np.bincount(row[order[1:][again]], minlength=rows)
    return out


def with_counts(docs: DataFrame) -> DataFrame:
    """Add the counts of ``text`` as LONG columns; all other columns pass through."""
    names = list(COUNTS)
    clash = set(names) & set(docs.columns)
    docs = docs.drop(*clash)
    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.LongType()) for n in names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                count_slice(data, offsets) for _, data, offsets in text_slices(batch.column("text"))
            ]
            added = [
                pa.array(
                    np.concatenate([p[name] for p in parts]) if parts else [], type=pa.int64()
                )
                for name in COUNTS
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], names=[*batch.schema.names, *names]
            )

    return map_arrow(docs, count, schema)


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)


def vector() -> list[Column]:
    """The transformed statistics, in the order of FLOORS: logs, and arcsine roots of shares."""
    n = {name: F.greatest(F.col(name), F.lit(1)).cast("double") for name in COUNTS}
    share = lambda part, whole: F.asin(
        F.sqrt(F.least(F.col(part) / n[whole], F.lit(1.0)))
    )
    return [
        F.log(n["word_chars"] / n["n_words"]),
        share("n_symbols", "word_chars"),
        share("n_upper", "word_chars"),
        share("n_punct", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
        F.log(n["n_distinct"]) / F.log(n["n_words"] + 1),
    ]


def cell(lang: str = "lang", source: str = "source") -> Column:
    """One text key for a language and source; NULL differs from every text."""
    return F.to_json(
        F.struct(F.col(lang).cast("string").alias("l"), F.col(source).cast("string").alias("s"))
    )


def chi2_cdf(x: float, d: int) -> float:
    """The chi-square distribution function, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, z = d / 2, x / 2
    term = total = 1 / a
    k = 1
    while term > total * 1e-16:
        term *= z / (a + k)
        total += term
        k += 1
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_tail(p: float, d: int) -> float:
    """The point that a chi-square value exceeds with probability ``p``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_cdf(mid, d) > p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the scatter of the nearest ``share`` of a normal sample must be multiplied by."""
    return share / chi2_cdf(chi2_tail(1 - share, DIMS), DIMS + 2)


def pooled_cells(vectors: DataFrame) -> DataFrame:
    """The group each cell is judged by, and the groups that its documents are part of.

    ``__q_group`` is the cell itself, its language or the whole table (NULL: no verdict);
    ``__q_groups`` also has the larger groups by which other cells are judged.
    """
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    lang = F.to_json(F.struct(F.col("lang").cast("string").alias("l")))
    sizes = sizes.select(
        F.concat(F.lit("cell "), cell()).alias("__q_own"),
        F.concat(F.lit("lang "), lang).alias("__q_lang"),
        cell().alias("__q_cell"),
        "n",
    )
    langs = sizes.groupBy("__q_lang").agg(
        F.sum("n").alias("__q_of_lang"), F.min("n").alias("__q_least")
    )
    total, least = langs.agg(F.sum("__q_of_lang"), F.min("__q_of_lang")).first()
    whole = F.lit("all" if (total or 0) >= MIN_TABLE else None).cast("string")
    own, common = F.col("n") >= MIN_GROUP, F.col("__q_of_lang") >= MIN_GROUP
    group = F.when(own, F.col("__q_own")).when(common, F.col("__q_lang")).otherwise(whole)
    parts = [
        F.when(own, F.col("__q_own")),
        F.when(common & (F.col("__q_least") < MIN_GROUP), F.col("__q_lang")),
        whole if (least or 0) < MIN_GROUP else F.lit(None).cast("string"),
    ]
    return sizes.join(langs, "__q_lang").select(
        "__q_cell", group.alias("__q_group"), F.array_compact(F.array(*parts)).alias("__q_groups")
    )


def _centres(bins: pd.DataFrame) -> pd.DataFrame:
    """Of each statistic's histogram: median, scaled median deviation, and the shortest half.

    ``middle`` is the middle of the shortest half as an offset from the median, ``half`` its scaled
    half-length. Many outliers on one side move the median, but not the shortest half.
    """
    medians, spreads = [0.0] * DIMS, [1.0] * DIMS
    middles, halves = [0.0] * DIMS, [1.0] * DIMS
    for j, part in bins.groupby("pos"):
        part = part.sort_values("bin")
        n = part["n"].cumsum().to_numpy()
        values = part["bin"].to_numpy()
        # the first bin by which the half that begins at each bin is full, if it gets full
        ends = np.searchsorted(n, n - part["n"].to_numpy() + (n[-1] + 1) // 2)
        begins = np.flatnonzero(ends < len(n))
        length = values[ends[begins]] - values[begins]
        at = begins[np.argmin(length)]
        middle = part["bin"].to_numpy()[np.searchsorted(n, (n[-1] + 1) // 2)]
        off = np.abs(part["bin"].to_numpy() - middle)
        order = np.argsort(off, kind="stable")
        n = part["n"].to_numpy()[order].cumsum()
        medians[j] = middle / _GRID
        middles[j] = ((values[at] + values[ends[at]]) / 2 - middle) / _GRID
        halves[j] = 1.4826 * length.min() / 2 / _GRID
        spreads[j] = 1.4826 * off[order][np.searchsorted(n, (n[-1] + 1) // 2)] / _GRID
    floors = list(FLOORS.values())
    out = {
        "__q_group": bins["__q_group"].iloc[0],
        "median": medians,
        "spread": np.maximum(spreads, floors).tolist(),
        "middle": middles,
        "half": np.maximum(halves, floors).tolist(),
    }
    return pd.DataFrame([out])


_ESTIMATE = "__q_group string, start int, centre array<double>, prec array<double>, logdet double, change double"


def estimate_from_bins(
    bins: pd.DataFrame, share: float | None, cutoff: float | None
) -> pd.DataFrame:
    """Centre and inverse scatter of the nearest rows of one group, from moments per bin.

    The nearest ``share`` of the rows counts (a bin that crosses the limit counts in part), or
    all rows up to the distance ``cutoff``.
    """
    out = []
    for start, part in bins.groupby("start"):
        part = part.sort_values("bin")
        n = part["n"].to_numpy(float)
        if cutoff is None:
            wanted = math.ceil(share * n.sum())
            weight = np.clip((wanted - (n.cumsum() - n)) / n, 0, 1)
            factor = consistency(share)
        else:
            weight = (2.0 ** (part["bin"].to_numpy() / _BINS) <= cutoff).astype(float)
            factor = consistency(REWEIGHT)
        moments = part[[f"s{i}" for i in range(DIMS)]].to_numpy()
        seconds = part[[f"p{i}_{j}" for i, j in PAIRS]].to_numpy()
        total = max((weight * n).sum(), 1.0)
        centre = weight @ moments / total
        scatter = np.zeros((DIMS, DIMS))
        for (i, j), value in zip(PAIRS, weight @ seconds / total):
            scatter[i, j] = scatter[j, i] = value - centre[i] * centre[j]
        scatter = factor * scatter + np.diag(np.square(list(FLOORS.values())))
        inverse = np.linalg.inv(scatter)
        logdet = float(np.linalg.slogdet(scatter)[1])
        out.append(
            {
                "__q_group": part["__q_group"].iloc[0],
                "start": int(start),
                "centre": np.round(centre, 10).tolist(),
                "prec": [round(float(inverse[i, j]), 8) for i, j in PAIRS],
                "logdet": logdet,
                "change": float(part["logdet"].iloc[0]) - logdet,
            }
        )
    return pd.DataFrame(out)


def distance(values: list[Column], centre: str = "centre", prec: str = "prec") -> Column:
    """The squared Mahalanobis distance as a column expression."""
    off = [v - F.get(centre, F.lit(i)) for i, v in enumerate(values)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + F.get(prec, F.lit(k)) * off[i] * off[j] * (1.0 if i == j else 2.0)
    return total


def _step(vectors: DataFrame, params: DataFrame, **how) -> DataFrame:
    z = [F.col(f"z{i}") for i in range(DIMS)]
    bin_no = F.floor(F.log2(distance(z) + 1e-9) * _BINS).cast("int")
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(z)]
    products = [F.sum(z[i] * z[j]).alias(f"p{i}_{j}") for i, j in PAIRS]
    bins = (
        vectors.join(params, "__q_group")
        .groupBy("__q_group", "start", "logdet", bin_no.alias("bin"))
        .agg(F.count("*").alias("n"), *sums, *products)
    )
    return per_group(
        bins, ["__q_group"], lambda part: estimate_from_bins(part, **how), _ESTIMATE
    )


def fit_groups(counted: DataFrame) -> DataFrame:
    """Robust centre and scatter for every cell of a counted table.

    ``counted`` has ``lang``, ``source`` and the counts; documents that fail the base rule take
    no part. Returns a row per cell: its key, medians, centre and inverse scatter.
    """
    passing = counted.where(~base_failed()).select(
        "lang", "source", F.col("n_words"), *[v.alias(f"x{i}") for i, v in enumerate(vector())]
    )
    cells = settle(pooled_cells(passing), "cells")
    # a row for each group that a document is part of: at most its cell, its language and the table
    placed = passing.withColumn("__q_cell", cell()).join(cells.drop("__q_group"), "__q_cell")
    placed = settle(
        placed.select(
            F.explode("__q_groups").alias("__q_group"), "n_words", *[f"x{i}" for i in range(DIMS)]
        ),
        "vectors",
    )
    bins = (
        placed.select("__q_group", F.posexplode(F.array(*[f"x{i}" for i in range(DIMS)])))
        .groupBy("__q_group", "pos", F.round(F.col("col") * _GRID).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    centres = settle(
        per_group(
            bins,
            ["__q_group"],
            _centres,
            "__q_group string, median array<double>, spread array<double>, "
            "middle array<double>, half array<double>",
        ),
        "medians",
    )
    damp = F.sqrt(F.col("n_words") / (F.col("n_words") + SETTLING_WORDS))
    vectors = settle(
        placed.join(centres, "__q_group").select(
            "__q_group",
            *[
                ((F.col(f"x{i}") - F.get("median", F.lit(i))) * damp).alias(f"z{i}")
                for i in range(DIMS)
            ],
        ),
        "centred",
    )
    def start(number: int, centre: Column, spread: str) -> Column:
        diagonal = F.array(
            *[
                1 / F.pow(F.get(spread, F.lit(i)), F.lit(2.0)) if i == j else F.lit(0.0)
                for i, j in PAIRS
            ]
        )
        return F.struct(F.lit(number).alias("start"), centre.alias("centre"), diagonal.alias("prec"))

    starts = [start(0, F.array(*[F.lit(0.0)] * DIMS), "spread"), start(1, F.col("middle"), "half")]
    params = centres.select("__q_group", F.inline(F.array(*starts))).select(
        "*", F.lit(float("inf")).alias("logdet"), F.lit(float("inf")).alias("change")
    )
    for step in range(MAX_STEPS):
        params = settle(
            _step(vectors, params.drop("change"), share=CORE, cutoff=None),
            "estimate",
        )
        worst = params.agg(F.max(F.abs("change"))).first()[0]
        if worst is None or (step and worst < 1e-3):
            break
    best = params.groupBy("__q_group").agg(
        F.min_by(F.struct("start", "centre", "prec", "logdet"), F.struct("logdet", "start")).alias("b")
    )
    final = settle(
        _step(
            vectors,
            best.select("__q_group", "b.*"),
            share=None,
            cutoff=chi2_tail(1 - REWEIGHT, DIMS),
        ),
        "reweighted",
    )
    return settle(
        cells.dropna(subset="__q_group")
        .join(final.join(centres, "__q_group"), "__q_group")
        .select(
            "__q_cell",
            *[F.col(c).alias(f"__q_{c}") for c in ("median", "centre", "prec")],
        ),
        "groups",
    )


def judge(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """Add ``__q_distance``, ``__q_failed`` (base rule) and ``__q_kept`` to counted documents.

    The estimates are joined by language and source; Spark broadcasts them where their measured
    size allows and otherwise splits the skewed keys of a sort-merge join.
    """
    n = F.col("n_words")
    damp = F.sqrt(n / (n + SETTLING_WORDS))
    z = [(v - F.get("__q_median", F.lit(i))) * damp for i, v in enumerate(vector())]
    beyond = F.col("__q_distance") > chi2_tail(TAIL, DIMS)
    return (
        counted.withColumn("__q_cell", cell())
        .join(groups, "__q_cell", "left")
        .withColumn("__q_distance", distance(z, "__q_centre", "__q_prec"))
        .withColumn("__q_failed", base_failed())
        .withColumn("__q_kept", ~F.col("__q_failed") & ~F.coalesce(beyond, F.lit(False)))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, squared distance, base rule and verdict of every document (row of ``docs``)."""
    slim = docs.select("doc_id", "lang", "source", "text")
    counted = settle(with_counts(slim).drop("text"), "counts")
    judged = judge(counted, fit_groups(counted))
    return judged.select(
        "doc_id",
        *COUNTS[:5],
        F.col("__q_failed").alias("base_failed"),
        F.col("__q_kept").alias("kept"),
        F.round("__q_distance", 3).alias("distance"),
        "lang",
        "source",
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with, whatever these are called.

    Texts are counted once: the counted documents are written, the estimates read their counts alone,
    and the verdict reads them again. No text is shuffled.
    """
    used = ("lang", "source", "text")
    names = [c if c in used else f"__q_own{i}" for i, c in enumerate(docs.columns)]
    counted = settle(with_counts(docs.toDF(*names)), "counted")
    judged = judge(counted, fit_groups(counted))
    return judged.where("__q_kept").select(
        *[F.col(name).alias(c) for name, c in zip(names, docs.columns)]
    )
