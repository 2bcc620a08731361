"""Document quality by attention over passages, learned from document labels.

Attention-based multiple-instance learning. A document is a bag of passages of at most
``PASSAGE_WORDS`` words. Each passage is encoded: style shares and a hashed histogram of byte
trigrams go through a learned layer. Gated attention gives every passage a weight, and the weighted
mean of the encodings is scored. Only documents carry labels; which passages matter is learned.

The model is trained on a bounded sample of labelled documents (``SAMPLE``, by smallest hash of
``doc_id``) outside the held-out fold. Every passage of every document is scored, in one scan that
moves no text.

Cases: NULL, empty and blank texts are a bag of one empty passage. Labels that are NULL, repeated
with both values, or without a document are left out. Without labels of both classes the score is
the share of good labels (0.5 without any). Repeated rows are scored each; extra columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.llm.common import free_name, map_arrow
from millrace.llm.textscan import flags, repeated, row_sums, salted_by_row, scan_words, text_slices

PASSAGE_WORDS = 96
TRIGRAMS = 32
FOLDS = 5
#: Labelled documents the model is fitted on, at most.
SAMPLE = 6000
THRESHOLD = 0.3
HIDDEN, GATE = 24, 12
EPOCHS, BATCH, RATE = 40, 64, 0.01
#: Bytes of a passage's histogram below which it counts in part.
_SMOOTH = 40.0

_CLASSES = (
    flags(bytes(range(65, 91))),
    flags(bytes(range(97, 123))),
    flags(bytes(range(48, 58))),
    flags(b"#*$%&|<>"),
    flags(b"!?"),
    flags(b".,;:"),
    flags(b"()[]{}/\\@=_~^+`\"'-"),
    flags(bytes(range(128, 256))),
    flags(b"\n"),
)
FEATURES = len(_CLASSES) + 5 + TRIGRAMS


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of a slice of texts, and the row each belongs to."""
    rows = len(offsets) - 1
    words = scan_words(data, offsets)
    counts = words.per_row(rows)
    first_word = np.concatenate(([0], np.cumsum(counts)))
    per_row = np.maximum(-(-counts // PASSAGE_WORDS), 1)
    row = np.repeat(np.arange(rows), per_row)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    # a passage runs from its first word to that of the next one, the first from the row's start
    at = first_word[row] + nth * PASSAGE_WORDS
    begin = np.where(nth == 0, offsets[row], words.begin[np.minimum(at, len(words.begin) - 1)] if len(words.begin) else 0)
    bounds = np.append(begin, offsets[-1])
    size = np.maximum(np.diff(bounds), 1).astype(float)
    which = np.searchsorted(begin, words.begin, "right") - 1
    n = np.maximum(np.bincount(which, minlength=len(row)), 1).astype(float)

    shares = [row_sums(chars[data], bounds) / size for chars in _CLASSES]
    length = np.bincount(which, words.end - words.begin, len(row)) / n
    again = repeated(salted_by_row(words.hash, which))
    key = salted_by_row(words.hash, which)
    distinct = np.bincount(which[np.unique(key, return_index=True)[1]], minlength=len(row)) / n
    follow = np.zeros(len(which), bool)
    follow[1:] = key[1:] == key[:-1]
    grams = np.zeros((len(row), TRIGRAMS))
    if len(data) > 2:
        code = data.astype(np.uint32)
        code = (code[:-2] * 961 + code[1:-1] * 31 + code[2:]) * np.uint32(2654435761)
        place = np.repeat(np.arange(len(row)), np.diff(bounds))[: len(code)]
        own = np.ones(len(data) + 2, bool)  # no trigram runs on into the next text
        own[np.maximum(offsets[1:] - 1, 0)] = own[np.maximum(offsets[1:] - 2, 0)] = False
        own = own[: len(code)]
        cells = place[own] * TRIGRAMS + (code[own] >> np.uint32(27)).astype(np.int64)
        grams = np.bincount(cells, minlength=len(row) * TRIGRAMS).reshape(-1, TRIGRAMS)
    features = np.column_stack(
        [
            *shares,
            np.log1p(length),
            np.log1p(np.bincount(which, minlength=len(row))) / 5,
            distinct,
            np.bincount(which, again, len(row)) / n,
            np.bincount(which, follow, len(row)) / n,
            np.sqrt(grams / (size + _SMOOTH)[:, None]),
        ]
    )
    return features, row


@dataclass
class Model:
    """Encoder (w, b), attention (v, u, a) and scorer (c, d), with the features' mean and scale."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, features: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        if self.constant is not None:
            return np.full(bags, self.constant)
        return forward(self.weights, (features - self.mean) / self.scale, bag, bags)["score"]


def forward(w: dict, x: np.ndarray, bag: np.ndarray, bags: int) -> dict:
    """Scores of bags; ``bag`` is sorted and names each passage's bag, every bag has one."""
    starts = np.searchsorted(bag, np.arange(bags))
    h = np.tanh(x @ w["w"] + w["b"])
    gate_t, gate_s = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
    raw = (gate_t * gate_s) @ w["a"]
    e = np.exp(raw - np.maximum.reduceat(raw, starts)[bag])
    attention = e / np.add.reduceat(e, starts)[bag]
    z = np.add.reduceat(h * attention[:, None], starts)
    logit = np.clip(z @ w["c"] + w["d"], -30, 30)
    score = 1 / (1 + np.exp(-logit))
    return dict(h=h, t=gate_t, s=gate_s, attention=attention, z=z, score=score)


def gradients(w: dict, x: np.ndarray, bag: np.ndarray, label: np.ndarray) -> dict:
    """Gradients of the mean log loss by back-propagation through the attention."""
    f = forward(w, x, bag, len(label))
    d_logit = (f["score"] - label) / len(label)
    d_z = d_logit[:, None] * w["c"]
    d_h = f["attention"][:, None] * d_z[bag]
    d_att = (f["h"] * d_z[bag]).sum(1)
    starts = np.searchsorted(bag, np.arange(len(label)))
    mean = np.add.reduceat(f["attention"] * d_att, starts)
    d_raw = f["attention"] * (d_att - mean[bag])
    d_t = d_raw[:, None] * w["a"] * f["s"] * (1 - f["t"] ** 2)
    d_s = d_raw[:, None] * w["a"] * f["t"] * f["s"] * (1 - f["s"])
    d_h = (d_h + d_t @ w["v"].T + d_s @ w["u"].T) * (1 - f["h"] ** 2)
    return {
        "w": x.T @ d_h,
        "b": d_h.sum(0),
        "v": f["h"].T @ d_t,
        "u": f["h"].T @ d_s,
        "a": ((f["t"] * f["s"]) * d_raw[:, None]).sum(0),
        "c": f["z"].T @ d_logit,
        "d": d_logit.sum(),
    }


def train(bags: list[np.ndarray], labels: list[int], seed: int = 7) -> Model:
    """Fit the model by Adam on whole bags."""
    y = np.array(labels, float)
    if len(set(labels)) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {}, float(y.mean()) if len(y) else 0.5)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-2
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"w": draw(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "v": draw(HIDDEN, GATE)}
    w |= {"u": draw(HIDDEN, GATE), "a": draw(GATE), "c": draw(HIDDEN), "d": np.zeros(())}
    first = {k: np.zeros_like(p) for k, p in w.items()}
    second = {k: np.zeros_like(p) for k, p in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            x = (np.concatenate([bags[i] for i in some]) - mean) / scale
            bag = np.repeat(np.arange(len(some)), [len(bags[i]) for i in some])
            step += 1
            for k, g in gradients(w, x, bag, y[some]).items():
                g = g + 1e-4 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                w[k] = w[k] - rate * m / (np.sqrt(v) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on at most SAMPLE labelled documents outside the held-out fold.

    The sample's ids are picked from the labels first, so their join with the documents is a
    broadcast of at most SAMPLE rows; what reaches the driver is their passages' features.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("__c_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("__c_label"))
        .where("low = __c_label")
        .drop("low")
    )
    sample = marked.orderBy(F.xxhash64("__c_id"), "__c_id").limit(SAMPLE)
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("__c_id"), "text")
        .join(F.broadcast(sample), "__c_id")
        .select("__c_id", "__c_label", "text")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for _, data, offsets in text_slices(batch.column("text")):
                features, row = passages(data, offsets)
                features = features.astype("<f4")
                bags += [features[row == i].tobytes() for i in range(len(offsets) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.int32()), pa.array(bags, pa.binary())],
                names=["doc_id", "label", "bag"],
            )

    rows = map_arrow(texts, encode, "doc_id long, label int, bag binary").dropDuplicates(["doc_id"])
    rows = sorted(rows.collect(), key=lambda r: r["doc_id"])
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    return train(bags, [r["label"] for r in rows])


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """Add the score of ``text``; all other columns pass through."""
    docs = docs.drop(name)
    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0)]
            for _, data, offsets in text_slices(batch.column("text")):
                features, row = passages(data, offsets)
                parts.append(model.score(features, row, len(offsets) - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(parts))],
                names=[*batch.schema.names, name],
            )

    return map_arrow(docs, score, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score, fold and predicted class of every document."""
    model = fit(docs, labels)
    scored = with_score(docs.select("doc_id", "text"), model, "score").drop("text")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with the columns they came with."""
    name = free_name(docs, "score")
    scored = with_score(docs, fit(docs, labels), name)
    return scored.where(F.col(name) >= THRESHOLD).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
