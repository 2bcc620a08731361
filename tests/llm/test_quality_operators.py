"""Quality rules and classifier against plain Python and on labelled text."""

import random
import re
from collections import Counter

import numpy as np
from millrace.llm import quality_classifier, quality_rules
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    spans = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(spans)
    covered = {k for i, s in enumerate(spans) if seen[s] > 1 for k in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def prose(rng, n):
    stems = ["lor", "ipsa", "dolo", "sit", "amet", "con", "sec", "adi", "pis", "elit"]
    return " ".join(rng.choice(stems) + rng.choice(stems) for _ in range(n)).capitalize() + "."


def test_base_counts(spark, docs, odd_pairs):
    rng = random.Random(1)
    pairs = odd_pairs + [(100 + i, "\n".join([prose(rng, 12)] * (1 + i % 3) + [prose(rng, 30)])) for i in range(30)]
    pairs += [(200, "x y z w v " * 4), (201, "a\n\na\n \na"), (202, "# * $ % & | < >")]
    found = quality_rules.quality_rules(docs(pairs)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = Counter((r["doc_id"], *(r[n] for n in names), r["base_failed"]) for r in found)
    want = Counter()
    for doc_id, text in pairs:
        counts = base(text)
        want[(doc_id, *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])] += 1
    assert got == want
    assert all(r["kept"] == (not r["base_failed"]) for r in found)  # too few for an estimate


def test_outliers_go_and_clean_documents_stay(spark, docs):
    rng = random.Random(2)
    pairs = [(i, prose(rng, rng.randint(12, 400))) for i in range(600)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in prose(rng, 80).split())) for i in range(60)]
    junk += [(2000 + i, prose(rng, 80).upper()) for i in range(60)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs(pairs + junk)).collect()}
    assert all(kept[i] for i, _ in pairs)
    assert not any(kept[i] for i, _ in junk)


def test_much_junk_of_one_kind_goes(spark, docs):
    """Up to 45 % of a source's documents may be junk of one kind, near or far."""
    rng = random.Random(3)
    kinds = [lambda w: w + "%%%", lambda w: w[:3] + "," + w[3:] + ";", str.upper]
    pairs, junk = [], set()
    for cell, (percent, kind) in enumerate([(30, 0), (35, 1), (40, 2), (45, 0), (45, 1), (45, 2)]):
        for i in range(300):
            doc_id, words = 1000 * cell + i, prose(rng, rng.randint(40, 300)).split()
            if i < 3 * percent:
                junk.add(doc_id)
                words = [kinds[kind](w) for w in words]
            pairs.append((doc_id, " ".join(words)))
    df = docs(pairs).withColumn("source", F.expr("CAST(doc_id DIV 1000 AS STRING)"))
    found = quality_rules.quality_rules(df).collect()
    assert {r["doc_id"] for r in found if not r["kept"]} == junk


def test_small_cells_are_judged_by_their_language_or_the_table(spark, docs):
    """Two rare sources (one without a name), a rare language, and a table of 60 documents."""
    rng = random.Random(4)
    small = docs([(i, prose(rng, 80) if i % 4 else prose(rng, 80).upper()) for i in range(60)])
    kept = {r["doc_id"] for r in quality_rules.quality_rules(small).collect() if r["kept"]}
    assert kept == {i for i in range(60) if i % 4}

    sizes = {("en", "big"): 200, ("en", "rare"): 20, ("en", None): 20, ("de", "other"): 20, (None, None): 20}
    rows, want = [], set()
    for (lang, source), n in sizes.items():
        for _ in range(n):
            # most of a rare source is junk, so its own estimate would keep it
            junk = n < 100 and rng.random() < 0.6
            text = prose(rng, rng.randint(40, 300))
            want |= set() if junk else {len(rows)}
            rows.append((len(rows), text.upper() if junk else text, lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = quality_rules.quality_rules(df).collect()
    assert all(r["distance"] is not None for r in found)
    assert {r["doc_id"] for r in found if r["kept"]} == want


def test_rules_on_an_empty_table_and_null_groups(spark, docs):
    assert quality_rules.quality_rules(docs([])).count() == 0
    df = docs([(1, "w " * 12)], lang=None, source=None)
    assert quality_rules.kept_documents(df).columns == df.columns


def test_chi_square_points():
    assert abs(quality_rules.chi2_tail(0.05, 1) - 3.841459) < 1e-5
    assert abs(quality_rules.chi2_tail(0.001, 7) - 24.321886) < 1e-5


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(7, 5)), np.array([0, 0, 0, 1, 2, 2, 2]), np.array([1.0, 0, 1])
    w = {"w": rng.normal(size=(5, 4)), "b": rng.normal(size=4), "v": rng.normal(size=(4, 3))}
    w |= {"u": rng.normal(size=(4, 3)), "a": rng.normal(size=3), "c": rng.normal(size=4), "d": np.array(0.1)}

    def loss(weights):
        p = quality_classifier.forward(weights, x, bag, 3)["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in quality_classifier.gradients(w, x, bag, y).items():
        step = np.zeros_like(w[name])
        at = (0,) * step.ndim
        step[at] = 1e-6
        slope = (loss(w | {name: w[name] + step}) - loss(w | {name: w[name] - step})) / 2e-6
        assert abs(slope - np.asarray(g)[at]) < 1e-6


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality_classifier.quality_scores(documents, labels).join(labels, "doc_id").collect()
    fold = [r for r in found if r["held_out"]]
    assert len(fold) > 20
    assert sum(r["predicted"] == r["quality"] for r in fold) / len(fold) > 0.95


def test_classifier_edges(spark, docs, odd_pairs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (None, 1), (99, 0)], "doc_id long, quality int")
    df = docs(odd_pairs)
    found = quality_classifier.quality_scores(df, labels).collect()
    assert len(found) == len(odd_pairs) and all(0 <= r["score"] <= 1 for r in found)
    assert quality_classifier.kept_documents(df, labels).columns == df.columns
    assert quality_classifier.quality_scores(docs([]), labels.where("false")).count() == 0
