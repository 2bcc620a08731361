"""Periodic runs against a definition-by-definition search."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic_runs as pr


def brute_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i, j - i + p), p)  # the smallest period of this stretch comes first
            i = j
    return sorted((s, p, length) for (s, length), p in found.items())


def brute(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs(w)
    gone = {i for s, p, length in runs for i in range(s + p, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = (None,) * 4
    if runs:
        from fractions import Fraction

        s, p, length = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]))
        best = (s, length, p, 1000 * length // p)
    lines = "".join(f"{s},{length},{p}\n" for s, p, length in runs)
    return (doc_id, len(runs), *best, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def sequences():
    rng = random.Random(11)
    out = [["a"] * n for n in (5, 6, 7, 64, 300)]
    for letters, n in (("ab", 40), ("ab", 200), ("abc", 120), ("abcdefgh", 400)):
        out += [[rng.choice(letters) for _ in range(n)] for _ in range(25)]
    for _ in range(60):
        p = rng.randint(1, 60)
        unit = [rng.choice("abcdefghijkl") for _ in range(p)]
        length = rng.randint(3 * p, 9 * p) + rng.randint(0, 3)
        body = [unit[i % p] for i in range(length)]
        if rng.random() < 0.3:
            body[rng.randrange(len(body))] = "!"
        out.append([str(k) for k in range(rng.randint(0, 30))] + body + [f"z{k}" for k in range(rng.randint(0, 30))])
    fib = ["a"], ["a", "b"]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    return out + [fib[1], fib[1] * 5, (["a", "b", "a", "b", "c"] * 4 + ["a", "b"] * 7) * 5]


def found_runs(words, tile_words=None):
    hashes = np.array([zlib.crc32(x.encode()) for x in words], np.uint64)
    pieces = {}
    for r, period, base, first, count, tile in pr.candidate_tiles(hashes, np.array([0, len(words)])):
        for p, s, e in pr.solve_tile(tile.tolist(), period, first, count):
            pieces.setdefault(p, []).append((base + s, base + e))
    runs = []
    for p, parts in pieces.items():
        held = None
        for s, e in sorted(parts) + [(10**9, 10**9)]:
            if held and s <= held[1]:
                held[1] = max(held[1], e)
                continue
            if held and held[1] - held[0] + p >= max(6, 4 * p):
                runs.append((held[0], p, held[1] - held[0] + p))
            held = [s, e]
    return sorted(runs)


@pytest.mark.parametrize("tile_words", [1, 40, 1 << 15])
def test_tiles_find_every_run_once(monkeypatch, tile_words):
    monkeypatch.setattr(pr, "TILE_WORDS", tile_words)
    monkeypatch.setattr(pr, "BLOCK", 64)
    for words in sequences():
        assert found_runs(words) == brute_runs(words), words


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.choice("ab") for _ in range(rng.randint(0, 30))]
        want = []
        for i in range(len(s)):
            k = 0
            while i + k < len(s) and s[k] == s[i + k]:
                k += 1
            want.append(k)
        assert pr.z_function(s) == want


def test_query_equals_brute_force(spark, docs, odd_pairs, monkeypatch):
    monkeypatch.setattr(pr, "TILE_WORDS", 100)
    pairs = [p for p in odd_pairs if p[0] not in (6, 7)]
    pairs += [(100 + i, " ".join(w)) for i, w in enumerate(sequences())]
    pairs += [(None, "x " * 30), (101, "y\ty\vy  " * 20), (101, "y\ty\vy  " * 20)]
    rng = random.Random(4)
    pairs += [(1000 + i, " ".join(str(rng.randint(0, 400)) for _ in range(rng.randint(1, 700)))) for i in range(80)]
    rows = [tuple(r) for r in pr.periodic_runs(docs(pairs)).collect()]
    assert sorted(rows, key=repr) == sorted((brute(i, t) for i, t in pairs), key=repr)
    assert sum(r[1] > 0 for r in rows) > 100


def test_long_document(spark, docs):
    words = [f"w{i % 9000}" for i in range(40_000)] + ["end"] + ["t"] * 50_000
    row = pr.periodic_runs(docs([(7, " ".join(words))])).first()
    assert zlib.crc32(b"7") % 10 and (row["n_runs"], row["start"], row["length"], row["period"]) == (2, 40_001, 50_000, 1)
    assert pr.periodic_runs(docs([])).count() == 0
