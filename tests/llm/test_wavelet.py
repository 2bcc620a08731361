"""Wavelet matrix files against plain arrays, and the archive against the tokenizers library."""

import io
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import wavelet


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def file_of(tokens):
    out = io.BytesIO()
    assert wavelet.write_shard(out, np.array(tokens, np.uint32), np.zeros((0, 5), np.int64)) == len(out.getvalue())
    return wavelet.WaveletFile(pa.BufferReader(out.getvalue()))


@pytest.mark.parametrize("top,n", [(1, 0), (1, 5), (2, 300), (50_000, 1000), (3, 5000), (2**32, 400)])
def test_access_count_and_select(monkeypatch, top, n):
    monkeypatch.setattr(wavelet, "BLOCK_BYTES", 16)
    rng = random.Random(n)
    tokens = [min(rng.randrange(top), rng.randrange(top)) for _ in range(n)]
    shard = file_of(tokens)
    assert shard.tokens().tolist() == tokens
    places = {}
    for k, t in enumerate(tokens):
        places.setdefault(t, []).append(k)
    for k in rng.sample(range(n), min(n, 60)):
        assert shard.token(k) == tokens[k]
    for t in [*list(places)[:8], 7, top, -1]:
        want = places.get(t, [])
        assert shard.count(t) == len(want) and list(shard.occurrences(t)) == want
        low, high = sorted((rng.randint(0, n), rng.randint(0, n)))
        assert list(shard.occurrences(t, low, high)) == [k for k in want if low <= k < high]
    for call in (lambda: shard.token(n), lambda: shard.select(tokens[0] if n else 0, n)):
        with pytest.raises(IndexError):
            call()


def test_a_cut_file_is_refused():
    out = io.BytesIO()
    wavelet.write_shard(out, np.arange(50, dtype=np.uint32), np.zeros((0, 5), np.int64))
    with pytest.raises(ValueError):
        wavelet.WaveletFile(pa.BufferReader(out.getvalue()[:-3]))


def test_joined_crc():
    for a, b in ((b"", b""), (b"x", b""), (b"", b"yz"), (b"some bytes", b"and others" * 77)):
        assert wavelet.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


SAMPLES = [
    "it's 'TIS we'll    x", "á bͅ ﬁ ẛ̣ ½ 123", "\n\n\tline one\n line  two\n", "x" * 3000 + " " + "y" * 999,
    "ends with space ", "  starts", "Σίσυφος ΟΔΟΣ İstanbul", "\x85 next line", "#@!<|x|> <|endoftext|>a", " ́x y", '" ' * 400,
]


@pytest.mark.parametrize("shard,piece", [(50, 64), (1 << 21, 1 << 21)])
def test_archive(spark, docs, odd_pairs, word, monkeypatch, folder, shard, piece):
    # tasks read the settings from their own copy of the module, so the encoder is tried here
    monkeypatch.setattr(wavelet, "PIECE", piece)
    pairs = [p for p in odd_pairs if shard > 50 or p[0] not in (6, 7)] + [(20 + i, t) for i, t in enumerate(SAMPLES)]
    table = wavelet.WordTable(public_tokenizers.path(wavelet.VOCABULARY))
    parts = {}
    for row, ids, _ in wavelet.encoded(pa.array([t for _, t in pairs], pa.string()), table):
        parts[row] = parts.get(row, []) + ids.tolist()
    ids = [word.encode(t or "", add_special_tokens=False).ids + [1] for _, t in pairs]
    assert [parts[k] + [1] for k in range(len(pairs))] == ids
    files = wavelet.settle(wavelet.write_shards(docs(pairs), folder, shard=shard), "shards")
    found = sorted(wavelet.read_documents(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in pairs), key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in found] == [sum(r["n_tokens"] for r in found[:k]) for k in range(len(found))]
    crc = lambda some: zlib.crc32(np.array(some, "<u4").tobytes())
    want = Counter((i, len(some), crc(some)) for (i, _), some in zip(pairs, ids))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == want
    counts = Counter(t for some in ids for t in some)
    asked = [1, *[t for t, _ in counts.most_common(4)], 49_000]
    got = {r["token"]: r["n"] for r in wavelet.token_counts(files, asked).collect()}
    assert got == {t: counts[t] for t in asked}
    rare = min(counts, key=lambda t: (counts[t], t))
    rows = wavelet.occurrences(files, [rare, 1]).collect()
    assert Counter((r["token"], r["doc_id"]) for r in rows) == Counter(
        (t, i) for (i, _), some in zip(pairs, ids) for t in some if t in (rare, 1)
    )
    ends = sorted(r["place"] for r in rows if r["token"] == 1)
    assert {r["start"] + r["n_tokens"] - 1 for r in found} <= set(ends)


def test_encoder_equals_the_library_on_odd_strings(word):
    rng = random.Random(9)
    parts = ["a", "Z", "word", "é", "À", "ß", "×", "÷", "'", "'s", "'LL", ",", ".", "<|endoftext|>", "<|EndOfText|>", "<", "|>", " ", "\t",
             "\u0301", "\u0338", "=", "\u00a0", "1", "23", "—", "İ", "I", "\u0307", "\x1c", "日", "-", "\x85", "ǆ", "K"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(3000)]
    table = wavelet.WordTable(public_tokenizers.path(wavelet.VOCABULARY))
    got = {row: ids.tolist() for row, ids, _ in wavelet.encoded(pa.array(texts), table)}
    for k, text in enumerate(texts):
        assert got[k] == word.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_archive(spark, docs):
    assert wavelet.token_archive(docs([])).count() == 0
