"""URL verdicts, WARC round trips, licence notices and quotations against plain Python."""

import hashlib
import random
import io
import math
import re
import zlib
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from millrace.llm import licenses, quotations, url_filter, warc

PAGES = "page_id long, url string, html string"


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def ruled(host, path):
    best = None
    for verdict, name, start in url_filter.RULES:
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            if best is None or len(name + start) > len(best[0]):
                best = (name + start, verdict)
    return best


def brute_verdicts(pages):
    counts = Counter()
    for _, _, html in pages:
        counts.update(w for w in re.findall("[a-z]+", (html or "").lower()) if len(w) <= 24)
    total = sum(counts.values()) or 1
    cut = lambda text: re.findall("[a-z]+|[0-9]+|[^\\x00-\\x7f]+", text)

    def tokens(host, path):
        out = []
        for label in cut(host):
            plain = re.fullmatch("[a-z]+", label) and len(label) <= 63
            out += url_filter.viterbi(label, counts, total) if plain else [label]
        path = re.sub("[A-Z]", lambda m: m[0].lower(), path)
        return out + [f"#{len(t)}" if t[0] in "0123456789" else t for t in cut(path)]

    sums, rows = {"allow": Counter(), "block": Counter()}, Counter()
    for _, url, _ in pages:
        host, path = split_url(url)
        if rule := ruled(host, path):
            sums[rule[1]].update(tokens(host, path))
            rows[rule[1]] += 1
    vocabulary = len(sums["allow"].keys() | sums["block"].keys())
    out = Counter()
    for page_id, url, _ in pages:
        host, path = split_url(url)
        if rule := ruled(host, path):
            out[(page_id, host, path, *rule)] += 1
            continue
        score = math.log((rows["block"] + 1) / (rows["allow"] + 1))
        for t in tokens(host, path):
            if t in sums["allow"] or t in sums["block"]:
                score += math.log((sums["block"][t] + 1) / (sums["block"].total() + max(vocabulary, 1)))
                score -= math.log((sums["allow"][t] + 1) / (sums["allow"].total() + max(vocabulary, 1)))
        out[(page_id, host, path, None, "block" if round(score, 9) > 0 else "allow")] += 1
    return out


def test_verdicts_equal_brute_force(spark):
    pages = [
        (r["page_id"], r["url"], r["html"])
        for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    ]
    pages += [
        (9001, None, None), (9002, "no scheme", ""), (9003, "HTTP://A.Example.NET/en/x?q#f", "x"), (9003, "HTTP://A.Example.NET/en/x?q#f", "x"),
        (9004, "http://example.com/de", "x"), (9005, "x://net", None), (9006, "x://net/", None), (9007, "a://b://org/fr/", "é"),
        (9008, "http://" + "longlabel" * 30 + ".com/" + "p" * 5000, "z"), (None, "http://blogtion.org/2024/01/?x://net/", "q"),
    ]
    df = spark.createDataFrame(pages, PAGES).selectExpr("*", "'own' AS host", "'own' AS verdict")
    got = url_filter.judge(df).collect()
    names = ("page_id", "host", "path", "rule", "verdict")
    assert Counter(tuple(r[n] for n in names) for r in got) == brute_verdicts(pages)
    assert url_filter.judge(df.where("false")).count() == 0


def test_viterbi_prefers_known_words():
    counts = {"black": 50, "bird": 40, "blackb": 1, "ird": 1}
    assert url_filter.viterbi("blackbird", counts, 100) == ["black", "bird"]
    assert "".join(url_filter.viterbi("qzxv", counts, 100)) == "qzxv"


def test_archives_return_every_page(spark):
    big = "é€x" * 900_000
    pages = [
        (1, "http://a", "same" * 50), (2, "http://b", "same" * 50), (2, "http://b", "same" * 50), (3, None, "same" * 24), (4, "u", "same" * 24),
        (5, "u", None), (6, "u", ""), (7, "u\nv", big), (8, "u", big), (None, "u", "same" * 50), (None, "u", "z" * 100), (None, "u", "z" * 100), (9, "u", "a\r\n\r\nb" * 40),
        (10, "u", "repeat" * 30), (10, "u", "repeat" * 30),
    ]
    got = warc.round_trip(spark.createDataFrame(pages, PAGES).selectExpr("*", "1 AS size")).collect()
    want, first, seen = Counter(), {}, set()
    for page_id, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        again = len(body) >= 100 and digest in seen
        seen.add(digest)
        first.setdefault(digest, page_id)
        kind = ("revisit", first[digest]) if again else ("response", None)
        want[(page_id, len(body), digest, *kind)] += 1
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(tuple(r[n] for n in names) for r in got) == want
    empty = spark.createDataFrame([], PAGES)
    assert warc.round_trip(empty).count() == 0


def test_records_are_cut_into_chunks_and_written_back(spark, tmp_path):
    """Payloads of many chunks, revisits of them, and an array that starts inside its buffer."""
    bodies = ["ä" * 700, None, "", "x" * 256, "long " * 5000, "x" * 256, "long " * 5000]
    pages = spark.createDataFrame([(i, f"u{i}", b) for i, b in enumerate(bodies)], PAGES)
    table = warc.chunk_rows(pages, 256)
    found = table.where("chunk_no >= 0").orderBy("row", "chunk_no").collect()
    heads = {r["row"]: r for r in table.where(f"chunk_no = {warc.HEAD}").collect()}
    pieces = {}
    for r in found:
        assert len(r["chunk"]) <= 256
        pieces.setdefault(heads[r["row"]]["page_id"], []).append(bytes(r["chunk"]))
    assert {i: b"".join(p) for i, p in pieces.items()} == {i: (b or "").encode() for i, b in enumerate(bodies)}
    assert all(len(p) == max(1, math.ceil(sum(map(len, p)) / 256)) for p in pieces.values())
    for h in heads.values():
        body = (bodies[h["page_id"]] or "").encode()
        assert (h["size"], h["digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert h["first_id"] == {5: 3, 6: 4}.get(h["page_id"]) and h["revisit"] == (h["page_id"] in (5, 6))
    archives = warc.write_archives(table, f"{tmp_path}/a", 2000)
    archives = spark.createDataFrame(archives.collect(), archives.schema)
    back = warc.read_archives(archives, chunk_bytes=1000).orderBy("record_id", "chunk_no").collect()
    read = {}
    for r in back:
        read[r["record_id"]] = read.get(r["record_id"], b"") + bytes(r["chunk"])
    want = {f"urn:page:{i}:0": (bodies[i] or "").encode() for i in range(5)} | {"urn:page:5:1": b"", "urn:page:6:1": b""}
    assert read == want
    column = pa.array(["ab", None, "", "xyz"])[1:]
    assert [bytes(p) for p in warc._payloads(column)] == [b"", b"", b"xyz"]
    assert list(warc._payloads(pa.array([], pa.string()))) == []


def test_chunk_rows_carry_running_digests():
    body = b"0123456789" * 500
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    head = warc.record_head(1, 0, "u", hashlib.sha256(body).hexdigest(), len(body), None)
    raw = packer.compress(head + body + b"\r\n\r\n") + packer.flush()
    rows = list(warc.read_stream(io.BytesIO(raw), 1024))
    assert [r["chunk_no"] for r in rows] == [0, 1, 2, 3, 4]
    assert b"".join(r["chunk"] for r in rows) == body
    for r in rows:
        assert r["digest_so_far"] == hashlib.sha256(body[: r["bytes_so_far"]]).hexdigest()
    with pytest.raises(ValueError):
        list(warc.read_stream(io.BytesIO(raw[:60]), 1024))


def test_license_passages(spark, docs, odd_pairs):
    notice = "This work is licensed under the GNU General Public License, version 3."
    pairs = odd_pairs + [
        (20, f"intro text here\n{notice}\nmore words follow"), (21, "ALL RIGHTS RESERVED!"), (22, "x\n\nReleased under\nthe MIT license.\n\ny"),
        (22, "x\n\nReleased under\nthe MIT license.\n\ny"), (23, "licensed under nothing"), (24, "Permission is hereby granted"), (None, "All rights reserved."),
    ]
    got = Counter(tuple(r)[:4] for r in licenses.license_passages(docs(pairs)).collect())
    assert got == Counter(
        [(20, "line", 1, "GPL-3.0"), (21, "line", 0, "all-rights-reserved"), (None, "line", 0, "all-rights-reserved")]
        + [(22, "paragraph", 1, "MIT"), (22, "text", 0, "MIT")] * 2  # the text is exactly at the threshold
    )
    assert licenses.license_passages(docs([])).count() == 0


def test_whole_licences_and_headers_of_each_version(spark, docs):
    gnu = "This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation; either version {2} of the License, or (at your option) any later version."
    cc = "This work is licensed under a Creative Commons Attribution-{} 4.0 International License."
    isc = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    isc += '\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    cases = [
        ("GPL-2.0", gnu.format("program", "General Public License", "2")),
        ("LGPL-2.1", gnu.format("library", "Lesser General Public License", "2.1")),
        ("LGPL-3.0", gnu.format("program", "Lesser General Public License", "3")),
        ("CC-BY-NC-SA-4.0", cc.format("NonCommercial-ShareAlike")),
        ("CC-BY-NC-ND-4.0", cc.format("NonCommercial-NoDerivatives")),
        ("CC-BY-ND-4.0", cc.format("NoDerivatives")),
        ("ISC", isc),
    ]
    cases += [(name, "Some Title\n\n" + text) for name, text in licenses.TEXTS]
    found = licenses.license_passages(docs([(i, text) for i, (_, text) in enumerate(cases)])).collect()
    best = {}
    for r in sorted(found, key=lambda r: r["dice"]):
        best[r["doc_id"]] = r["license"]
    assert best == {i: name for i, (name, _) in enumerate(cases)}
    assert {name for name, _ in licenses.TEXTS} >= {"BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "Zlib"}


def test_windows_of_words_equal_sql(spark, docs):
    """Notices inside lines, wrapped notices in longer paragraphs, and licences with other text around."""
    import duckdb

    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choice(["stone", "of the", "river", "in this", "software", "cold", "license"]) for _ in range(n))
    cases = ["Copyright 2024 Example Press. All rights reserved.", "All parts were made by hand. Released under the MIT License."]
    cases += ["licensed under the mit license released under the mit license", "Released under the MIT License. Released under the MIT License."]
    texts = dict(licenses.TEXTS)
    for _, text in licenses.HEADERS + licenses.TEMPLATES:
        words = text.split()
        cases.append(f"{filler(9)} {text} {filler(7)}")
        cases.append(filler(8) + "\n" + "\n".join(" ".join(words[i : i + 6]) for i in range(0, len(words), 6)) + "\n" + filler(60))
        cases.append(filler(3) + " " + " ".join(w for w in words if rng.random() > 0.12) + " " + filler(30))
    for name in ("MIT", "BSD-3-Clause", "ISC", "Zlib"):
        around = " ".join(f"word{rng.randrange(5000)}" for _ in range(900))
        cases.append(around + "\n" + texts[name].strip() + "\n" + around)  # one paragraph
    cases += [filler(400), "", " \n\n "]
    pairs = list(enumerate(cases)) + [(0, cases[0]), (None, cases[1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs + [(9000, None)])
    key = lambda r: tuple((v is None, v) for v in r)
    got = sorted((tuple(r) for r in licenses.license_passages(docs(pairs + [(9000, None)])).collect()), key=key)
    assert got == sorted(con.execute(licenses.LICENSE_SQL).fetchall(), key=key)
    windows = {(r[0], r[3]) for r in got if r[1] == "window"}
    assert {(0, "all-rights-reserved"), (1, "MIT"), (None, "MIT"), (len(cases) - 4, "Zlib"), (len(cases) - 5, "ISC")} <= windows


def test_every_whole_licence_equals_sql(spark, docs):
    import duckdb

    pairs = [(i, text) for i, (_, text) in enumerate(licenses.ALL_TEMPLATES)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs)
    got = sorted(tuple(r) for r in licenses.license_passages(docs(pairs)).collect())
    assert got == sorted(con.execute(licenses.LICENSE_SQL).fetchall())
    assert len({r[0] for r in got}) == len(pairs)


def test_size_bounds_lose_no_match():
    templates = licenses.Templates()
    for grams in templates.grams:
        for cut in range(1, len(grams) + 1):
            part = grams[:cut]
            best = max(
                2.0 * len(set(part) & set(g)) / (len(part) + len(g)) for g in templates.grams
            )
            found = templates.best(part, licenses.THRESHOLD)
            assert (found is not None) == (best >= licenses.THRESHOLD)
            assert found is None or found[2] == best


def test_matches_at_the_threshold_equal_sql(spark, docs):
    pairs = [
        (1, "q licensed under the mit license z"),  # 4 shared of 6 and 4: exactly 0.8
        (2, "x\n\nReleased under\nthe MIT license.\n\ny"),
        (3, "a b licensed under the mit license z"),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs)
    got = sorted(tuple(r) for r in licenses.license_passages(docs(pairs)).collect())
    assert got == sorted(con.execute(licenses.LICENSE_SQL).fetchall())
    assert (1, "line", 0, "MIT", 6, 4, 0.8) in got


MESSAGES = "conv_id long, turn long, role string, text string"


def test_replies_follow_their_originals(spark):
    chat = [
        (1, 0, "a", "First question?\n\nSecond part\nof it."), (1, 1, "b", "> first QUESTION?\nAn answer."), (1, 2, "c", "A new topic."),
        (1, 3, "a", "> An answer.\n>> First question?\nThanks."), (1, 4, "b", "> Second part of it.\nMore."), (1, 5, "c", "> never said\nHm"),
        (1, 6, "a", ">of it.\n> A new\n> topic.\nBoth"), (2, 0, "a", "> An answer."), (2, 1, "a", None), (2, 2, "a", ""), (None, 0, "a", "> x"), (2, None, "a", "> x"),
        (2, 2, "a", ""),
    ]
    df = spark.createDataFrame(chat, MESSAGES).selectExpr("*", "1 AS thread", "2 AS quotes")
    rows = quotations.reply_ordered(df).collect()
    assert len(rows) == len(chat)
    by = {(r["conv_id"], r["turn"]): r for r in rows}
    reply = {t: by[(1, t)]["reply_to"] for t in range(7)}
    assert reply == {0: None, 1: 0, 2: None, 3: 1, 4: 0, 5: None, 6: 2}
    assert (by[(1, 3)]["thread"], by[(1, 3)]["depth"], by[(1, 3)]["n_linked"]) == (0, 2, 2)
    assert by[(1, 3)]["text"] == "Thanks." and by[(2, 1)]["text"] is None
    places = sorted((r["position"], r["turn"]) for r in rows if r["conv_id"] == 1)
    assert [t for _, t in places] == [0, 1, 3, 4, 2, 6, 5]
    assert sorted(r["position"] for r in rows if r["conv_id"] == 2) == [0, 1, 2, 3, 4]
    assert quotations.reply_ordered(df.where("false")).count() == 0


def test_long_reply_chains(spark):
    chat = [(1, i, "a", (f"> message {i - 1}\n" if i else "") + f"message {i}") for i in range(60)]
    rows = quotations.reply_ordered(spark.createDataFrame(chat, MESSAGES)).collect()
    assert all((r["thread"], r["depth"], r["position"]) == (0, r["turn"], r["turn"]) for r in rows)


def test_long_labels_are_split(spark):
    """A label longer than host names may be is split like any other."""
    html = "<p>" + "river stone market garden " * 50 + "</p>"
    rows = [(1, "http://" + "riverstonemarketgarden" * 4 + ".org/a", html), (2, "http://riverstone.net/b", html)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labels = spark.createDataFrame([("riverstonemarketgarden" * 4,), ("a",)], "label string")
    found = {r["label"]: r["words"] for r in url_filter.segment_labels(labels, url_filter.word_counts(pages)).collect()}
    assert found["riverstonemarketgarden" * 4] == ["river", "stone", "market", "garden"] * 4 and found["a"] == ["a"]
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(pages).collect()}[2] == "block"
