"""Licence notices in documents, by the Dice coefficient over word bigrams.

A text is normalised to its words: runs of letters and digits, A-Z in lower case. Each line, each
paragraph of more than one line and each text of more than one paragraph is a passage, and its
distinct bigrams are compared with those of every template whose size allows the threshold:
2 * shared >= t * (n + m) is impossible unless n lies between t / (2 - t) and (2 - t) / t times m.
The best template of a passage is reported.

A notice that shares its line or paragraph with other words is found by windows: wherever a text holds
enough of a template's bigrams, every stretch of as many words as the template has that begins with
one of them is compared. Windows that touch a passage reported already don't count; of windows that
overlap one another the best is reported (the first of equals).

Everything happens where a document is read: the templates are few and fixed, so nothing is moved.

Cases: NULL, empty and one-word passages match nothing. Repeated rows and rows without ``doc_id``
are scanned each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_arrow
from millrace.llm.license_texts import HEADERS, TEXTS
from millrace.llm.textscan import LOWER, WORD, flags, salted_by_row, scan_words, text_slices, windows

THRESHOLD = 0.8

#: Notices by which works name their licence, under SPDX identifiers.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
)

#: All that the scan compares with: the notices above, standard headers, and whole licence texts.
ALL_TEMPLATES = TEMPLATES + HEADERS + TEXTS

_LETTERS = flags(bytes([*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]))
KINDS = ("line", "paragraph", "text", "window")


def bigram_hashes(text: str) -> np.ndarray:
    """Hashes of the word bigrams of a text, in order."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = scan_words(LOWER[data], np.array([0, len(data)]), _LETTERS)
    return windows(words, 2)[0]


class Templates:
    """The templates' bigrams, sorted together for one look-up of all bigrams of a slice."""

    def __init__(self, templates=TEMPLATES):
        self.names = [name for name, _ in templates]
        spelled = [bigram_hashes(text) for _, text in templates]
        self.lengths = np.array([len(g) for g in spelled])  # of windows, in bigrams
        self.grams = [np.unique(g) for g in spelled]
        self.sizes = np.array([len(g) for g in self.grams])
        self.all = np.unique(np.concatenate(self.grams))
        # the templates that hold each of the bigrams
        owner = np.repeat(np.arange(len(templates)), self.sizes)
        place = np.searchsorted(self.all, np.concatenate(self.grams))
        order = np.argsort(place, kind="stable")
        self.owners, self.first = owner[order], np.searchsorted(place[order], np.arange(len(self.all) + 1))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.all, hashes), len(self.all) - 1)
        return self.all[at] == hashes

    def best(self, grams: np.ndarray, threshold: float) -> tuple[str, int, float] | None:
        """Name, shared bigrams and Dice coefficient of the best template within size bounds."""
        n, found = len(grams), None
        # the coefficient if all of the smaller set were shared, computed as below: no rounding
        # can put a template at the threshold outside its bounds
        most = 2.0 * np.minimum(self.sizes, n) / (self.sizes + n)
        for k in np.flatnonzero(most >= threshold):
            shared = len(np.intersect1d(grams, self.grams[k], assume_unique=True))
            dice = 2.0 * shared / (n + len(self.grams[k]))
            if dice >= threshold and (found is None or (-dice, self.names[k]) < (-found[2], found[0])):
                found = (self.names[k], shared, dice)
        return found


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and row of each line of a slice, and its number in the row."""
    begins = np.zeros(len(data), bool)
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    begins[1:] |= data[:-1] == 10
    starts = np.flatnonzero(begins)
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(row, row)
    return starts, row, np.arange(len(row)) - first


def scan_slice(data: np.ndarray, offsets: np.ndarray, templates: Templates, threshold: float):
    """Rows (row, kind, position, template, bigrams, shared, dice) of a slice of texts."""
    if not len(data):
        return
    words = scan_words(LOWER[data], offsets, _LETTERS)
    gram, same_row = windows(words, 2)
    starts, line_row, line_no = _lines(data, offsets)
    filled = np.add.reduceat(WORD[data].astype(np.int64), starts) > 0
    opens = filled & ~(np.concatenate(([False], filled[:-1])) & (line_no > 0))
    paragraph = np.cumsum(opens) - 1
    line = np.searchsorted(starts, words.begin, "right") - 1
    row_of_paragraph = line_row[opens]
    first_paragraph = np.searchsorted(row_of_paragraph, row_of_paragraph)
    lines_in = np.bincount(paragraph[filled], minlength=max(opens.sum(), 1))
    paragraphs_in = np.bincount(row_of_paragraph, minlength=len(offsets) - 1)
    units = (
        (line, line_row, line_no, np.ones(len(starts), bool)),
        (paragraph[line], row_of_paragraph, np.arange(len(row_of_paragraph)) - first_paragraph, lines_in > 1),
        (words.row, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, int), paragraphs_in > 1),
    )
    hits = templates.contains(gram) & same_row
    starts_of_rows = np.searchsorted(words.row, np.arange(len(offsets)))
    covered: dict[int, list] = {}
    for kind, (unit, row, position, counts) in zip(KINDS, units):
        inside = same_row & (unit[:-1] == unit[1:]) & counts[unit[:-1]]
        touched = np.zeros(len(row) + 1, bool)
        touched[unit[:-1][hits & inside]] = True
        at = np.flatnonzero(inside & touched[unit[:-1]])
        if not len(at):
            continue
        at = at[np.unique(salted_by_row(gram[at], unit[at]), return_index=True)[1]]
        owner = unit[at]
        n = np.bincount(owner, minlength=len(row))
        met = np.bincount(owner[hits[at]], minlength=len(row))
        order = np.argsort(owner, kind="stable")
        bounds = np.concatenate(([0], np.cumsum(n)))
        for u in np.flatnonzero((n > 0) & (2.0 * met >= threshold * (n + met) - 1e-9)):
            grams = np.sort(gram[at[order[bounds[u] : bounds[u + 1]]]])
            found = templates.best(grams, threshold)
            if found:
                yield row[u], kind, position[u], found[0], len(grams), *found[1:]
                span = np.searchsorted(unit, [u, u + 1]) - starts_of_rows[row[u]]
                covered.setdefault(int(row[u]), []).append((int(span[0]), int(span[1])))
    yield from _windows(gram, hits, words.row, starts_of_rows, covered, templates, threshold)


def _windows(gram, hits, word_row, starts, covered, templates: Templates, threshold: float):
    """Rows of kind window of the texts that hold enough of a template."""
    at = np.flatnonzero(hits)
    if not len(at):
        return
    at = at[np.unique(salted_by_row(gram[at], word_row[at]), return_index=True)[1]]
    place = np.searchsorted(templates.all, gram[at])
    many = templates.first[place + 1] - templates.first[place]
    inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    template = templates.owners[np.repeat(templates.first[place], many) + inner]
    pair, shared = np.unique(np.repeat(word_row[at], many) * len(templates.names) + template, return_counts=True)
    row, template = np.divmod(pair, len(templates.names))
    # of n and m bigrams as many are shared as t * (n + m) / 2 at least, and n is no fewer than that
    enough = shared * (2 - threshold) >= threshold * templates.sizes[template] - 1e-9
    for r in np.unique(row[enough]):
        text = gram[starts[r] : starts[r + 1] - 1]
        order = np.argsort(text, kind="stable")
        same = np.flatnonzero(text[order][1:] == text[order][:-1])
        before = np.full(len(text), -1)
        before[order[same + 1]] = order[same]
        found = []
        for k in template[enough & (row == r)]:
            found += _best_windows(text, before, templates, k, threshold)
        taken = covered.get(int(r), [])
        open_, reach = None, -1
        for one in sorted(found):
            begin, end = one[:2]
            if any(begin < b and a < end for a, b in taken):
                continue
            if open_ is not None and begin >= reach:
                yield (r, "window", *open_)
                open_ = None
            reach = end if open_ is None else max(reach, end)
            if open_ is None or (-one[5], one[2], begin) < (-open_[4], open_[1], open_[0]):
                open_ = (begin, *one[2:])
        if open_ is not None:
            yield (r, "window", *open_)


def _best_windows(text, before, templates: Templates, k: int, threshold: float) -> list[tuple]:
    """Begin, end, licence, bigrams, shared, dice of every window of one template at the threshold.

    A bigram counts in the windows that hold it but not its last occurrence before, so running sums
    of where that begins and ends give the distinct bigrams of all windows.
    """
    length, last = int(templates.lengths[k]), len(text) - int(templates.lengths[k])
    if last < 0:
        return []
    grams = templates.grams[k]
    at = np.minimum(np.searchsorted(grams, text), len(grams) - 1)
    member = grams[at] == text
    place = np.arange(len(text))
    low = np.maximum(before + 1, place - length + 1)
    low = np.maximum(low, 0)
    counts = []
    for some in (np.ones(len(text), bool), member):
        some = some & (low <= place)
        change = np.bincount(low[some], minlength=len(text) + 1) - np.bincount(place[some] + 1, minlength=len(text) + 1)
        counts.append(np.cumsum(change)[: last + 1])
    n, shared = counts
    dice = 2.0 * shared / (n + len(grams))
    good = np.flatnonzero(member[: last + 1] & (dice >= threshold))
    return [(int(s), int(s) + length + 1, templates.names[k], int(n[s]), int(shared[s]), float(dice[s])) for s in good]


_SCHEMA = "doc_id long, kind string, position long, license string, n_bigrams long, shared long, dice double"


def license_passages(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every passage that matches a template: where it is, the licence, and the coefficient."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(ALL_TEMPLATES)
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        names = [part.split()[0] for part in _SCHEMA.split(", ")]
        for batch in batches:
            ids = batch.column("doc_id")
            rows = [
                (ids[first + int(row)].as_py(), *rest)
                for first, data, offsets in text_slices(batch.column("text"))
                for row, *rest in scan_slice(data, offsets, templates, threshold)
            ]
            columns = zip(*rows) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], names=names
            )

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), scan, _SCHEMA)


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = """regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+')"""
_BIGRAMS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"

#: The same result for the oracle, from the same templates.
LICENSE_SQL = f"""
WITH template(no, license, txt) AS (VALUES {", ".join(f"({i}, {_sql_text(a)}, {_sql_text(t)})" for i, (a, t) in enumerate(ALL_TEMPLATES))}),
base AS (SELECT row_number() OVER () AS tid, doc_id, text FROM documents),
lines AS (
    SELECT tid, unnest(string_split(text, chr(10))) AS txt,
           unnest(range(len(string_split(text, chr(10))))) AS position FROM base
), blocks AS (
    SELECT tid, list_filter(string_split_regex(text, '\\n(?:[ \\t\\r\\x0b\\x0c]*\\n)+'),
                            lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS parts FROM base
), paragraphs AS (
    SELECT tid, unnest(parts) AS txt, unnest(range(len(parts))) AS position FROM blocks
), units AS (
    SELECT tid, 'line' AS kind, position, {_WORDS.format("txt")} AS w, TRUE AS counts FROM lines
    UNION ALL
    SELECT tid, 'paragraph', position, {_WORDS.format("txt")},
           len(list_filter(string_split(txt, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]'))) > 1
    FROM paragraphs
    UNION ALL
    SELECT tid, 'text', 0, {_WORDS.format("text")}, len(parts) > 1 FROM base JOIN blocks USING (tid)
), passages AS (
    SELECT row_number() OVER () AS id, * FROM (
        SELECT *, CAST(coalesce(sum(len(w)) OVER (PARTITION BY tid, kind ORDER BY position
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first_word FROM units)
    WHERE counts AND len(w) > 1
), template_words AS (SELECT no, license, {_WORDS.format("txt")} AS w FROM template),
template_sets AS (
    SELECT no, license, len(w) - 1 AS length, list_distinct({_BIGRAMS}) AS b FROM template_words
), template_grams AS (SELECT no, license, length, len(b) AS m, unnest(b) AS g FROM template_sets),
grams AS (
    SELECT id, len(b) AS n, unnest(b) AS g FROM (SELECT id, list_distinct({_BIGRAMS}) AS b FROM passages)
), scored AS (
    SELECT p.id, t.no, any_value(license) AS license, any_value(p.n) AS n, count(*) AS shared,
           2.0::DOUBLE * count(*) / (any_value(p.n) + any_value(t.m)) AS dice
    FROM grams p JOIN template_grams t USING (g) GROUP BY p.id, t.no
), best AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY dice DESC, license) AS place
    FROM scored WHERE dice >= {THRESHOLD}
), found AS (
    SELECT tid, kind, position, license, n, shared, dice, first_word, first_word + len(w) AS end_word
    FROM best JOIN passages USING (id) WHERE place = 1
), text_words AS (SELECT tid, {_WORDS.format("text")} AS w FROM base),
text_grams AS (
    SELECT tid, unnest(range(len(w) - 1)) AS pos, unnest({_BIGRAMS}) AS g, len(w) - 1 AS n_grams
    FROM text_words WHERE len(w) > 1
), hits AS (SELECT tid, pos, g, n_grams, no, length, m FROM text_grams JOIN template_grams USING (g)),
likely AS (
    SELECT tid, no FROM hits GROUP BY tid, no
    HAVING count(DISTINCT g) * (2 - {THRESHOLD}) >= {THRESHOLD} * any_value(m) - 1e-9
), likely_texts AS (
    SELECT tid, list(g ORDER BY pos) AS gs FROM text_grams WHERE tid IN (SELECT tid FROM likely) GROUP BY tid
), cut AS (
    SELECT tid, no, pos, length, list_distinct(gs[pos + 1 : pos + length]) AS held
    FROM hits JOIN likely USING (tid, no) JOIN likely_texts USING (tid) WHERE pos + length <= n_grams
), windows AS (
    SELECT tid, no, pos, pos + c.length + 1 AS end_word, license, len(held) AS n,
           len(list_intersect(held, b)) AS shared,
           2.0::DOUBLE * len(list_intersect(held, b)) / (len(held) + len(b)) AS dice
    FROM cut c JOIN template_sets USING (no)
), apart AS (
    SELECT w.* FROM windows w WHERE dice >= {THRESHOLD} AND NOT EXISTS (
        SELECT 1 FROM found f WHERE f.tid = w.tid AND w.pos < f.end_word AND f.first_word < w.end_word)
), reached AS (
    SELECT *, max(end_word) OVER (PARTITION BY tid ORDER BY pos, end_word, no
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM apart
), islands AS (
    SELECT *, sum(CASE WHEN reach IS NULL OR pos >= reach THEN 1 ELSE 0 END)
              OVER (PARTITION BY tid ORDER BY pos, end_word, no ROWS UNBOUNDED PRECEDING) AS island FROM reached
), told AS (
    SELECT *, row_number() OVER (PARTITION BY tid, island ORDER BY dice DESC, license, pos, no) AS place FROM islands
), matches AS (
    SELECT tid, kind, position, license, n, shared, dice FROM found
    UNION ALL SELECT tid, 'window', pos, license, n, shared, dice FROM told WHERE place = 1
)
SELECT doc_id, kind, position, license, n AS n_bigrams, shared, dice FROM matches JOIN base USING (tid)
"""
