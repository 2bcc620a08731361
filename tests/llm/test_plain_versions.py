"""The outlier verdict and reply order against direct calculations without Spark."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import quality_rules, quotations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    """The transformed statistics of one text, by their definitions."""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(spans)
    covered = {k for i, s in enumerate(spans) if seen[s] > 1 for k in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    root = lambda part, whole: math.asin(math.sqrt(min(part / whole, 1)))
    return [
        math.log(chars / len(words)),
        root(len(re.findall(r"[#*$%&|<>]", text)), chars),
        root(len(re.findall("[A-Z]", text)), chars),
        root(len(re.findall(r"[!\"'(),\-./:;?@\[\\\]^_`{}~+=]", text)), chars),
        root(len(lines) - len(set(lines)), len(lines)),
        root(len(covered), len(words)),
        math.log(len(set(words))) / math.log(len(words) + 1),
    ]


def plain_distances(texts):
    """Squared distances by a minimum covariance determinant over whole vectors, no histograms."""
    x = np.array([statistics(t) for t in texts])
    n, dims = x.shape
    words = np.array([len(WORD.findall(t)) for t in texts])
    z = (x - np.median(x, axis=0)) * np.sqrt(words / (words + 50))[:, None]
    floors = np.array(list(quality_rules.FLOORS.values()))
    half = math.ceil(n / 2)

    def estimate(rows, factor):
        centre = rows.mean(axis=0)
        return centre, factor * np.cov(rows.T, bias=True) + np.diag(floors**2)

    def distances(centre, scatter):
        off = z - centre
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off)

    raw = x - np.median(x, axis=0)
    mad = np.maximum(1.4826 * np.median(np.abs(raw), axis=0), floors)
    middles, spans = [], []
    for column in np.sort(raw, axis=0).T:
        length = column[half - 1 :] - column[: n - half + 1]
        at = int(length.argmin())
        middles.append((column[at] + column[at + half - 1]) / 2)
        spans.append(1.4826 * length[at] / 2)
    starts = [
        (np.zeros(dims), np.diag(mad**2)),
        (np.array(middles), np.diag(np.maximum(spans, floors) ** 2)),
    ]
    found = []
    for centre, scatter in starts:
        for _ in range(50):
            nearest = np.argsort(distances(centre, scatter))[:half]
            centre, scatter = estimate(z[nearest], quality_rules.consistency(0.5))
        found.append((np.linalg.slogdet(scatter)[1], centre, scatter))
    _, centre, scatter = min(found, key=lambda f: f[0])
    near = distances(centre, scatter) <= quality_rules.chi2_tail(0.025, dims)
    return distances(*estimate(z[near], quality_rules.consistency(0.975)))


def test_outlier_verdicts_equal_plain_estimates(spark):
    rng = random.Random(11)
    stems = ["lor", "ipsa", "dolo", "sit", "amet", "con", "sec", "adi", "pis", "elit", "vel", "nunc"]
    odd = [lambda w: w + "%%", str.upper, lambda w: w[:2] + "," + w[2:] + ";", lambda w: w * 3]
    rows = []
    for source, kind, share in (("a", 0, 0.1), ("b", 1, 0.3), ("c", 2, 0.2), ("d", 3, 0.0)):
        for _ in range(400):
            words = ["".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(rng.randint(40, 300))]
            if rng.random() < share:
                words = [odd[kind](w) for w in words]
            elif rng.random() < 0.1:  # between clean and odd
                words = [odd[kind](w) if rng.random() < 0.15 else w for w in words]
            rows.append((len(rows), " ".join(words).capitalize() + ".", "en", source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(df).collect()}
    cutoff = quality_rules.chi2_tail(quality_rules.TAIL, quality_rules.DIMS)
    gaps = []
    for source in "abcd":
        cell = [r for r in rows if r[3] == source and not got[r[0]]["base_failed"]]
        for (doc_id, *_), want in zip(cell, plain_distances([r[1] for r in cell])):
            gaps.append(abs(got[doc_id]["distance"] - want) / max(want, 1))
            if abs(math.log(want / cutoff)) > 0.2:
                assert got[doc_id]["kept"] == (want < cutoff), (source, doc_id, want)
    assert np.median(gaps) < 0.05 and max(gaps) < 0.2


def plain_key(passage):
    return " ".join(passage.lower().split())


def plain_parts(text):
    paragraphs = re.split(r"\n[ \t\r]*\n", text)
    parts = [text, *paragraphs, *text.split("\n")]
    parts += [s for p in paragraphs for s in re.split(r"(?<=[.!?])\s+", p)]
    return {plain_key(p) for p in parts} - {""}


def plain_replies(chat):
    """Reply, thread, depth and place of every message, conversation by conversation."""
    own, quotes = {}, {}
    for conv, turn, _, text in chat:
        mine, levels = [], []
        for line in (text or "").split("\n"):
            rest, level = line.lstrip(" \t"), 0
            while rest.startswith(">"):
                rest, level = rest[1:], level + 1
                rest = rest[1:] if rest[:1] in (" ", "\t") else rest
            levels.append((level, rest if level else line))
            if not level:
                mine.append(line)
        own[conv, turn] = "\n".join(mine).strip("\n")
        runs = []
        for i, (level, rest) in enumerate(levels):
            if i and levels[i - 1][0] == level:
                runs[-1][1].append(rest)
            else:
                runs.append((level, [rest]))
        quotes[conv, turn] = [(lv, "\n".join(ls)) for lv, ls in runs if lv and plain_key("\n".join(ls))]
    first = defaultdict(dict)
    for conv, turn in sorted(own):
        for part in plain_parts(own[conv, turn]):
            first[conv].setdefault(part, turn)
    out, reply = {}, {}
    for (conv, turn), found in quotes.items():
        origins = []
        for level, passage in found:
            known = lambda key: first[conv].get(key) if first[conv].get(key, turn) < turn else None
            origin = known(plain_key(passage))
            if origin is None:
                origin = max((t for t in map(known, plain_parts(passage)) if t is not None), default=None)
            origins.append((level, origin))
        reply[conv, turn] = max((o for lv, o in origins if lv == 1 and o is not None), default=None)
        out[conv, turn] = [len(found), sum(o is not None for _, o in origins)]
    for conv, turn in out:
        root, depth = turn, 0
        while reply[conv, root] is not None:
            root, depth = reply[conv, root], depth + 1
        out[conv, turn] += [reply[conv, turn], root, depth]
    for conv in {c for c, _ in out}:
        order = sorted((out[c, t][3], t) for c, t in out if c == conv)
        for place, (_, turn) in enumerate(order):
            out[conv, turn] += [place, own[conv, turn]]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_reply_order_equals_a_plain_replay(spark, seed):
    rng = random.Random(seed)
    said = ["yes", "no, never.", "see you", "What now? I wait.", "one\n\ntwo", "fine. good. so", "it is late"]
    chat = []
    for conv in range(25):
        texts = []
        for turn in range(rng.randint(1, 14)):
            lines = []
            for _ in range(rng.randint(0, 3)):
                if texts and rng.random() < 0.8:
                    source = rng.choice(texts).split("\n")
                    begin = rng.randrange(len(source))
                    mark = rng.choice(["> ", ">", ">> ", "> > ", " >"])
                    lines += [mark + line.upper() for line in source[begin : begin + rng.randint(1, 4)]]
                lines.append(rng.choice(said) + (f" {conv}-{turn}" if rng.random() < 0.6 else ""))
            texts.append("\n".join(lines))
            chat.append((conv, turn, rng.choice("ab"), texts[-1]))
    rows = quotations.reply_ordered(
        spark.createDataFrame(rng.sample(chat, len(chat)), "conv_id long, turn long, role string, text string")
    ).collect()
    names = ("n_quotes", "n_linked", "reply_to", "thread", "depth", "position", "text")
    got = {(r["conv_id"], r["turn"]): [r[n] for n in names] for r in rows}
    assert got == plain_replies(chat)
    assert sum(r["reply_to"] is not None for r in rows) > 20
