"""Licence scans against a plain comparison of every span of lines with every template."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa

from vecloom.llm.license_scan import LARGEST, Templates, license_matches, word_matches
from vecloom.llm.license_templates import TEMPLATES, known_licences


def bigrams(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text))
    words = ["license" if w == "licence" else "licensed" if w == "licenced" else w for w in words]
    return Counter(zip(words, words[1:]))


def test_each_template_is_found_in_other_text_and_clean_text_has_none(spark):
    rows = [(i, f"Some words before.\n{text.replace('License', 'Licence')}\nand after", "x") for i, text in enumerate(TEMPLATES.values())]
    rows += [(100, None, None), (None, "", "y"), (101, "the software is good and the license was read", "z")]
    found = {r.doc_id: r.matches for r in license_matches(spark.createDataFrame(rows, "doc_id long, text string, matches string"), TEMPLATES).collect()}
    for i, name in enumerate(TEMPLATES):
        best = max(found[i], key=lambda m: m.dice)
        assert (best.license, best.first_line, best.dice) == (name, 1, 1.0)
    assert found[100] == found[None] == found[101] == []
    assert license_matches(spark.createDataFrame([], "doc_id long, text string"), TEMPLATES).count() == 0


def word_model(text, templates, least):
    """All spans of words, the most similar first, none that shares a word with one before."""
    words = [(w.group().lower(), (text or "").count("\n", 0, w.start())) for w in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+", text or "")]
    spans = []
    for name in templates:
        wanted = bigrams(templates[name])
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + 3 * wanted.total())):
                own = bigrams(" ".join(w for w, _ in words[a:b + 1]))
                dice = 2 * (own & wanted).total() / (own.total() + wanted.total())
                if dice >= least:
                    spans.append((-dice, -wanted.total(), a, b, name))
    taken, found = [], {}
    for dice, _, a, b, name in sorted(spans):
        if all(b < c or d < a for c, d in taken):
            taken.append((a, b))
            found.setdefault(name, (name, -dice, words[a][1], words[b][1]))
    return [found[name] for name in sorted(found)]


def test_scan_of_words_equals_brute_force():
    r = random.Random(6)
    templates = {"one": "Licensed under the A License", "two": "licensed under the B licence version 2", "three": "a b\nc d e a b f g a b", "word": "alone"}
    pieces = [*templates.values(), "Licenced under", "the A", "a b c", "d e", "a b f", "g a b", "noise here", "é", "", "!", "licensed under the B"]
    texts = [None, "", "\n\n", "alone"] + ["".join(r.choice(pieces) + r.choice([" ", "\n", ", "]) for _ in range(r.randint(1, 9))) for _ in range(150)]
    for least in (0.6, 0.9, 1.0):
        found = word_matches(pa.array(texts, pa.string()), Templates(templates, least))
        assert found == [word_model(t, templates, least) for t in texts]
        assert sum(map(len, found)) > 20


def test_notices_inside_a_line_are_found_and_versions_decide():
    texts = ["Copyright (c) 2020 A. Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
             "Prose first. This work is licensed under the GNU General Public License, version 2. Prose between, released under the MIT License, and after."]
    found = [[m[0] for m in own] for own in word_matches(pa.array(texts), Templates(TEMPLATES, 0.9))]
    assert found == [["mit-notice"], ["gpl-3.0-notice"], ["gpl-2.0-notice", "mit-notice"]]


def test_licences_beyond_the_given_notices_are_known():
    known = known_licences()
    assert sum(map(len, known.values())) < LARGEST
    full = {name: text for name, text in known.items() if name.endswith("-text")}
    assert {"gpl-2-text", "gpl-3-text", "lgpl-2.1-text", "apache-2.0-text", "mpl-2.0-text", "cc0-1.0-text"} <= set(full)
    texts = {**full, **{name: known[name] for name in ("bsd-2-clause", "bsd-3-clause", "zlib", "boost-1.0", "unlicense", "gpl-2.0-header", "gpl-3.0-header",
                                                       "lgpl-2.1-header", "agpl-3.0-header", "mpl-2.0-header", "gpl-2.0-or-later-spdx", "mit-spdx")}}
    found = word_matches(pa.array([f"Prose before. {text} Prose after." for text in texts.values()]), Templates(known, 0.9))
    for name, own in zip(texts, found):
        assert max(own, key=lambda m: m[1])[:2] == (name, 1.0)
