"""BPE round trips and packing against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, packing

SAMPLES = [
    "it's 'TIS we'll  \u00a0 x", "a\u0301 b\u0345 \ufb01 \u1e9b\u0323 \u00bd 123", "\n\n\tline one\n line  two\n", "x" * 3000 + " " + "y" * 999,
    "ends with space ", " \u2003starts", "Σίσυφος ΟΔΟΣ İstanbul", "\U0001f468\u200d\U0001f469\u200d\U0001f467 flag", "\x85 next\u2028line", "#@!<|x|>",
]


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("bits", [2, 9])
def test_encoding_equals_the_library(spark, docs, odd_pairs, word, bits, monkeypatch):
    monkeypatch.setattr(bpe, "CUT_BITS", bits)
    pairs = odd_pairs + [(100 + i, t) for i, t in enumerate(SAMPLES)]
    encoder = bpe.WordEncoder(public_tokenizers.path(bpe.VOCABULARY))
    import pyarrow as pa

    texts = [t for _, t in pairs]
    got = [pair for part in bpe.chunk_texts(pa.array(texts, pa.string())) for pair in encoder.encode(part)]
    for text, (ids, decoded) in zip(texts, got):
        want = word.encode(text or "", add_special_tokens=False).ids
        assert ids.decode() == " ".join(map(str, want))
        assert decoded.decode() == word.decode(want, skip_special_tokens=False)


def test_encode_documents(spark, docs, odd_pairs, word):
    found = bpe.encode_documents(docs(odd_pairs), full=True).collect()
    want = Counter()
    for i, t in odd_pairs:
        ids = word.encode(t or "", add_special_tokens=False).ids
        want[(i, len(ids), " ".join(map(str, ids)))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids"]) for r in found) == want
    assert bpe.encode_documents(docs([])).count() == 0


def check_packing(rows, pairs, byte):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    want = Counter()
    for i, t in pairs:
        ids = byte.encode(t or "", add_special_tokens=False).ids + [0]
        bounds = packing.cut(len(ids))
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert Counter(tuple(r[n] for n in names) for r in rows) == want
    return len(by_sequence)


def test_packing_places_every_piece(spark, docs, odd_pairs, byte):
    rng = random.Random(3)
    pairs = odd_pairs + [(200 + i, t) for i, t in enumerate(SAMPLES)]
    pairs += [(1000 + i, "the cat sat " * rng.randint(1, 700)) for i in range(150)]
    rows = packing.pack_documents(docs(pairs), with_ids=True).collect()
    used = check_packing(rows, pairs, byte)
    assert used <= 1.02 * sum(r["length"] for r in rows) / packing.CAPACITY + 1
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packing.pack_documents(docs([])).count() == 0


def test_genomes_hold_every_item_once():
    rng = random.Random(8)
    counts = Counter(rng.choice([rng.randint(1, 100), rng.randint(300, 1100)]) for _ in range(3000))
    genomes = packing.evolve(counts, [], 1, 2048)
    child = packing.crossover(genomes[0], genomes[-1], counts, rng, 2048)
    for genome in [*genomes, child, packing.mutate(child, rng, 2048)]:
        held = Counter()
        for pattern, times in genome.items():
            assert sum(pattern) <= 2048
            for n in pattern:
                held[n] += times
        assert held == counts
    assert sum(genomes[0].values()) <= sum(packing.fill_bins(counts, None, 2048).values())


def test_chunk_reuse_counts_every_chunk(spark, docs, odd_pairs):
    shared = " ".join(f"shared{i}" for i in range(900))
    pairs = odd_pairs + [(200 + i, f"start {i} {shared} end {i}") for i in range(12)]
    import pyarrow as pa

    texts = pa.array([t for _, t in pairs if t], pa.string())
    chunks = Counter(
        c.encode()
        for part in bpe.chunk_texts(texts)
        for text in part
        for c in ([text] if isinstance(text, str) else text)
    )
    got = bpe.chunk_reuse(docs(pairs).repartition(3)).first()
    assert (got["n_chunks"], got["distinct_chunks"]) == (sum(chunks.values()), len(chunks))
    assert got["n_bytes"] == sum(len((t or "").encode()) for _, t in pairs)
    assert got["distinct_bytes"] == sum(map(len, chunks))
    assert got["distinct_chunks"] < got["task_chunks"] < got["n_chunks"]
    assert got["distinct_bytes"] <= got["task_bytes"] <= got["n_bytes"]
    none = bpe.chunk_reuse(docs([(1, None), (2, "")])).first()
    assert set(none.asDict().values()) == {0}
