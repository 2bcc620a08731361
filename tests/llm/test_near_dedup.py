"""Near duplicates against all pairs of a small table."""

import random
import re
from collections import Counter

import numpy as np
from millrace.llm import graph, near_dedup


def sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(pairs):
    """Component of each doc_id: links between all pairs of rows, and within a doc_id."""
    root = {i: i for i, _ in pairs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    rows = [(i, sets(t)) for i, t in pairs if i is not None]
    for a, s in rows:
        for b, t in rows:
            both = len(s & t)
            if s and t and 100 * both >= 85 * (len(s) + len(t) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in root}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family(seed, members=60):
    rng = random.Random(seed)
    pairs, n = [], 100
    for size in (5, 7, 20, 60, 150, 400):
        words = [f"w{rng.randrange(5000)}" for _ in range(size)]
        for k in range(members // 6):
            pairs.append((n, edited(rng, words, k % 5)))
            n += rng.randrange(1, 4)
    return pairs


def check(found, pairs):
    want = brute(pairs)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found)
    assert got == Counter(
        (i, len(sets(t)), want.get(i), i is None or want[i] == i) for i, t in pairs
    )


def test_components_equal_all_pairs(spark, docs, odd_pairs):
    pairs = odd_pairs + family(3) + [(900, "A B c"), (901, "a b C"), (902, "a b")]
    check(near_dedup.near_duplicates(docs(pairs)).collect(), pairs)


def test_groups_cut_into_blocks_lose_no_link(spark, docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 4)
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 3)
    pairs = family(5, 90)
    check(near_dedup.near_duplicates(docs(pairs)).collect(), pairs)


def test_one_document_of_each_group_stays(spark, docs, odd_pairs):
    pairs = odd_pairs + family(9)
    df = docs(pairs)
    kept = near_dedup.kept_documents(df)
    assert kept.columns == df.columns
    want = brute(pairs)
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted(i for i, c in want.items() if i == c)
    assert kept.where("doc_id IS NULL").count() == 1


def test_empty_table(spark, docs):
    assert near_dedup.near_duplicates(docs([])).count() == 0


def test_estimate_follows_the_true_similarity():
    rng = np.random.default_rng(4)
    for size, share in ((40, 0.9), (400, 0.85), (4000, 0.5)):
        pool = np.unique(rng.integers(0, 2**63, 3 * size, dtype=np.uint64))
        both = int(size * share * 2 / (1 + share))
        a, b = np.sort(pool[:size]), np.sort(np.concatenate((pool[:both], pool[size : 2 * size - both])))
        equal = (near_dedup.registers(a) == near_dedup.registers(b)).mean()
        assert abs(equal - share) < 0.15


def test_components_of_a_long_chain(spark, rows):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "u long, v long")
    got = rows(graph.components(edges))
    assert got == sorted([(i, 0) for i in range(1, 41)] + [(100, 90)], key=repr)
    assert graph.components(edges.where("false")).count() == 0


def test_components_around_hubs(spark, rows, monkeypatch):
    monkeypatch.setattr(graph, "HUB_ROWS", 5)
    star = [(50, 50 + i) for i in range(1, 40)] + [(89, 3), (200, 201), (3, 7)]
    wheel = [(300 + i, 330) for i in range(30)] + [(300, 2), (329, 1)]
    edges = spark.createDataFrame(star + wheel, "u long, v long")
    want = [(i, 3) for i in [7, *range(50, 90)]] + [(201, 200)] + [(i, 1) for i in [2, *range(300, 331)]]
    assert rows(graph.components(edges)) == sorted(want, key=repr)


def test_component_steps_plan_over_settled_tables(spark, rows, monkeypatch):
    """No step's plan repeats how an earlier one came about; with and without hubs."""
    leaves, settle = [], graph.settle

    def spy(df, name):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return settle(df, name)

    monkeypatch.setattr(graph, "settle", spy)
    edges = spark.createDataFrame([(1, 1 + i) for i in range(1, 20)] + [(20, 30), (30, 31)], "u long, v long")
    for hub_rows in (1_000, 5):
        monkeypatch.setattr(graph, "HUB_ROWS", hub_rows)
        assert rows(graph.components(edges)) == sorted([(i, 1) for i in [*range(2, 21), 30, 31]], key=repr)
        assert max(leaves) <= 9
