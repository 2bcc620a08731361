"""Spelling variants against a comparison of all words with all others."""

import random
import re
import zlib
from collections import Counter

import pytest

from millrace.llm import spelling

UPPER = {i: i + 32 for i in range(65, 91)}


def brute(pairs):
    counts = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            if i is not None:
                h = zlib.crc32(f"{i}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    others = {w: [v for v in words if v != w and near(w, v)] for w in words}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(others[w]), words.get(form.get(w))))
    return sorted(out)


def texts(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(25)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "überall", "Nothing", "nothingé"]
    out = []
    for i in range(120):
        words = [rng.choice(base[: 1 + int(len(base) * rng.random() ** 2)]) for _ in range(40)]
        for k in range(0, 40, 5):
            at = rng.randrange(len(words[k]) + 1)
            words[k] = words[k][:at] + rng.choice(["", "a", "É", "é"]) + words[k][at + rng.randint(0, 1) :]
        out.append((i, " ".join(words) + rng.choice(["", ".", "×÷!", "\n"])))
    return out


@pytest.mark.parametrize("limit", [4096, 2])
def test_variants_equal_brute_force(spark, docs, odd_pairs, monkeypatch, limit):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (limit,))
    pairs = texts(limit) + odd_pairs + [(1, "Nothing nothinf " * 30), (1, "Nothing nothinf " * 30), (None, "x" * 5000 + " nothinfs nothinfs")]
    found = spelling.spelling_variants(docs(pairs))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) > 100 and any(r[1] for r in rows)
    assert sorted(rows) == brute(pairs)


def test_no_words(spark, docs):
    assert spelling.spelling_variants(docs([])).count() == 0
    assert spelling.spelling_variants(docs([(1, None), (2, "short"), (3, "onceonly")])).count() == 0


def test_every_place_has_one_bound():
    rng = random.Random(5)
    grams = frozenset("".join(rng.choice("ab") for _ in range(n)) for n in (1, 1, 2, 2, 3) for _ in range(3))
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        bounds = spelling.affected(word, grams)
        chars = Counter(x for _, _, lo, hi, _, _ in bounds for x in range(lo, hi))
        gaps = Counter(x for *_, lo, hi in bounds for x in range(lo, hi))
        assert chars == Counter(range(len(word))) and gaps == Counter(range(len(word) + 1))
        assert all(a <= x < b for a, b, lo, hi, _, _ in bounds for x in range(lo, hi))
