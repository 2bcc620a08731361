"""Near-duplicate documents by HyperMinHash signatures and exact confirmation.

A document's set holds its distinct five-word shingles as 64-bit hashes. The hash space is cut
into 128 buckets; each bucket keeps, of its smallest hash, the count of leading zeros and ten
mantissa bits: a register of 16 bits. Empty buckets borrow from others in an order fixed for each
bucket, so short texts compare as well. Five registers at a time form a band; documents that
agree on a band are candidates. Between candidates the share of equal registers, less the share
expected by chance, estimates the Jaccard similarity; estimates near or above the threshold join
candidates into groups, and inside these groups links are confirmed on the full sets.

At the threshold of 0.85 a link shares none of the 25 bands with probability below 1e-6, and an
estimate falls under ``ESTIMATE_FLOOR`` (4.5 standard errors lower) with about the same one.

Scale. Equal sets collapse to one class first, by a grouped minimum. No pair list of a group is
ever made: inside a task, a search over the links not yet explained leaves one row per member. A
group too big for a task is cut into blocks and each pair of blocks meets in a task of its own.

Cases: NULL, empty and blank texts have an empty set, are linked with nothing and kept. Rows of
one ``doc_id`` count as one document. A row without ``doc_id`` takes no part: no component, kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import by_task, free_name, group_bounds, in_blocks, map_arrow, settle, whole_groups
from millrace.llm.graph import components
from millrace.llm.textscan import LOWER, mix, scan_words, text_slices, windows

SHINGLE = 5
#: A link needs PERCENT * union <= 100 * intersection.
PERCENT = 85
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BANDS, BAND_ROWS = 25, 5
REGISTERS = BANDS * BAND_ROWS
ESTIMATE_FLOOR = 0.70
#: Members of one block while estimating, and shingle hashes of one block while confirming.
BLOCK_ROWS = 4096
BLOCK_HASHES = 2_000_000
BLOCK_SETS = 2048

_probe = np.argsort(
    mix(np.arange(BUCKETS * BUCKETS, dtype=np.uint64) + np.uint64(7)).reshape(BUCKETS, BUCKETS),
    axis=1,
)
_edges = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column."""
    for _, data, offsets in text_slices(column):
        words = scan_words(LOWER[data], offsets)
        rows = len(offsets) - 1
        value, whole = windows(words, SHINGLE)
        counts = words.per_row(rows)
        firsts = np.concatenate(([0], np.cumsum(counts)))
        for row in range(rows):
            a, b = firsts[row], firsts[row + 1]
            if b - a >= SHINGLE:
                yield np.unique(value[a : b - SHINGLE + 1])
            elif b > a:  # the whole sequence of a short text is its one shingle
                short = np.array([b - a], np.uint64)
                for at in range(a, b):
                    short = short * _ODD + words.hash[at : at + 1]
                yield mix(short)
            else:
                yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a non-empty sorted set."""
    at = np.searchsorted(hashes, _edges)
    low = hashes[np.minimum(at, len(hashes) - 1)]
    full = (at < len(hashes)) & (low >> np.uint64(64 - BUCKET_BITS) == np.arange(BUCKETS))
    rest = (low << np.uint64(BUCKET_BITS)) | np.uint64((1 << BUCKET_BITS) - 1)
    # leading zeros of the rest, by the exponent of its upper half
    high = (rest >> np.uint64(11)).astype(np.float64)
    zeros = (53 - np.frexp(high)[1]).astype(np.uint64)
    shifted = rest << (np.minimum(zeros, 62) + np.uint64(1))
    packed = (zeros << np.uint64(MANTISSA_BITS)) | (shifted >> np.uint64(64 - MANTISSA_BITS))
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _probe[empty]
        packed[empty] = packed[order[np.arange(len(empty)), full[order].argmax(axis=1)]]
    return packed[:REGISTERS].astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of each row of registers."""
    parts = regs.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(BAND_ROWS):
        key = mix(key * _ODD + parts[:, :, i])
    return key.view(np.int64)


_SIGNATURE = "doc_id long, n_shingles long, digest binary, regs binary, bands array<long>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, regs = [], [], []
        for hashes in shingle_sets(batch.column("text")):
            sizes.append(len(hashes))
            digests.append(
                hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None
            )
            regs.append(registers(hashes) if len(hashes) else None)
        full = [r for r in regs if r is not None]
        keys = iter(band_keys(np.stack(full)) if full else ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([None if r is None else r.tobytes() for r in regs], pa.binary()),
                pa.array([None if r is None else next(keys) for r in regs], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "digest", "regs", "bands"],
        )


def needed_matches(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Equal registers that make the collision-corrected estimate reach ESTIMATE_FLOOR.

    Unrelated registers agree by chance at the rate of 0.16992 * 2**-bits, scaled down where the
    sizes of the sets differ (the published approximation of the expected collisions).
    """
    ratio = np.maximum(size_a, size_b) / np.maximum(np.minimum(size_a, size_b), 1)
    chance = 0.169919487159739 * 2.0**-MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2
    return REGISTERS * (ESTIMATE_FLOOR * (1 - chance) + chance)


def roots(n: int, linked) -> np.ndarray:
    """For each of ``n`` members the first member it is connected to.

    ``linked(i, others)`` tells which of the others member ``i`` is linked with. A member found
    once is not looked at again, so a well-connected group costs about one look per member.
    """
    root = np.arange(n)
    left = np.arange(n)
    while len(left):
        seed, left = left[0], left[1:]
        queue = [seed]
        while queue and len(left):
            hit = linked(queue.pop(), left)
            if hit.any():
                root[left[hit]] = seed
                queue.extend(left[hit].tolist())
                left = left[~hit]
    return root


def _estimated_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in whole_groups(batches, "task"):
        task, rep = group["task"].to_numpy(), group["rep"].to_numpy()
        size = group["weight"].to_numpy()
        regs = group["regs"].combine_chunks().cast(pa.large_binary())
        regs = np.frombuffer(regs.buffers()[2], np.uint16, len(task) * REGISTERS, regs.offset * 2 * REGISTERS)
        regs = regs.reshape(-1, REGISTERS)
        bounds = group_bounds(task)
        pair = bounds[:-1][np.diff(bounds) == 2]
        near = (regs[pair] == regs[pair + 1]).sum(1) >= needed_matches(size[pair], size[pair + 1])
        us, vs = [rep[pair[near] + 1]], [rep[pair[near]]]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a < 3:
                continue
            part, sizes = regs[a:b], size[a:b]
            root = roots(
                b - a,
                lambda i, others: (part[others] == part[i]).sum(1)
                >= needed_matches(sizes[others], sizes[i]),
            )
            moved = root != np.arange(b - a)
            us.append(rep[a:b][moved])
            vs.append(rep[a:b][root[moved]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [hashes.tobytes() for hashes in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("root"), batch.column("doc_id"), pa.array(sets, pa.binary())],
            names=["root", "rep", "hashes"],
        )


def _confirmed_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in whole_groups(batches, "task"):
        task, rep = group["task"].to_numpy(), group["rep"].to_numpy()
        blobs = group["hashes"].combine_chunks()
        us, vs = [], []
        bounds = group_bounds(task)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a < 2:
                continue
            sets = [np.frombuffer(blobs[i].as_buffer(), np.uint64) for i in range(a, b)]
            sizes = np.array([len(s) for s in sets])

            def linked(i, others):
                sound = 100 * np.minimum(sizes[others], sizes[i]) >= PERCENT * np.maximum(
                    sizes[others], sizes[i]
                )
                hit = np.zeros(len(others), bool)
                near = np.flatnonzero(sound)
                if not len(near):
                    return hit
                flat = np.concatenate([sets[k] for k in others[near]])
                own = sets[i]
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                starts = np.concatenate(([0], np.cumsum(sizes[others[near]])[:-1]))
                both = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
                union = sizes[i] + sizes[others[near]] - both
                hit[near] = 100 * both >= PERCENT * union
                return hit

            root = roots(b - a, linked)
            moved = root != np.arange(b - a)
            us.append(rep[a:b][moved])
            vs.append(rep[a:b][root[moved]])
        if us:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
            )


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, set digest, registers and band keys of every document."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_arrow(slim, _signatures, _SIGNATURE)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    signed = settle(signatures(docs), "signatures")
    known = signed.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = settle(
        known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    firsts = (
        known.join(classes.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"])
        .select(F.col("doc_id").alias("rep"), "n_shingles", "regs", "bands", "digest")
        .dropDuplicates(["rep", "digest"])
        .drop("digest")
    )
    firsts = settle(firsts, "firsts")
    banded = firsts.select(
        F.explode("bands").alias("band"), "rep", F.col("n_shingles").alias("weight")
    )
    meeting = in_blocks(banded, "band", "rep", F.ceil(F.col("n") / BLOCK_ROWS))
    candidates = meeting.select("task", "rep", "weight").join(firsts.select("rep", "regs"), "rep")
    likely = by_task(candidates, "rep", _estimated_links, "u long, v long")
    groups = components(likely, "likely")

    # every member of a group of likely duplicates, with its full set
    members = groups.union(groups.select("root", "root")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        "doc_id IS NOT NULL"
    )
    members = members.select(F.col("node").alias("doc_id"), "root").hint("shuffle_hash")
    joined = texts.join(members, "doc_id").select("root", "doc_id", "text")
    full = settle(map_arrow(joined, _sets, "root long, rep long, hashes binary"), "sets")
    full = full.withColumn("weight", F.length("hashes") / 8)
    blocks = F.greatest(
        F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("weight_all") / BLOCK_HASHES)
    )
    meeting = in_blocks(full, "root", "rep", blocks).select("task", "rep", "hashes")
    links = by_task(meeting, "rep", _confirmed_links, "u long, v long")
    # several texts of one doc_id make it one document; it links what any of them links
    same = (
        known.groupBy("doc_id")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .join(known.select("doc_id", "digest"), "doc_id")
        .join(classes, "digest")
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    )
    linked = components(links.union(same), "linked")

    labelled = (
        classes.join(linked, F.col("rep") == F.col("node"), "left")
        .select("digest", F.coalesce("root", "rep").alias("label"), "rep", "copies")
        .where("copies > 1 OR label <> rep")
        .select("digest", "label")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(labelled, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The first document of every component, with all its columns.

    Rows that repeat a kept ``doc_id`` stay as one: the one whose text has the smallest digest, so a
    rerun keeps the same text; of equal texts any row. Rows without ``doc_id`` stay as they are, since
    nothing can be linked to them.
    """
    gone_id, row = free_name(docs, "gone_id"), free_name(docs, "row")
    found = near_duplicates(docs)
    gone = found.where("NOT kept").select(F.col("doc_id").alias(gone_id)).distinct()
    named = docs.where("doc_id IS NOT NULL")
    stay = named.join(gone, F.col("doc_id").cast("long") == F.col(gone_id), "left_anti")
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = stay.groupBy(F.col("doc_id").alias(gone_id)).agg(F.min_by(whole, digest).alias(row))
    one = one.select(*[F.col(f"{row}.`{c}`") for c in docs.columns])
    return one.union(docs.where("doc_id IS NULL"))
