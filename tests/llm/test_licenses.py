import re

import pytest

from tessera.llm import licenses
from tessera.llm.licenses import evaluate, read_expression

UP = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))
    places = []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


def found(r):
    return r.n_words, sorted((p.word, p.label) for p in r.places if p.base)


def test_places_equal_brute_force(spark, corpus, rng):
    parts = ["under the MIT", "apache license", "cc by", "under", "the", "MIT", "license", "Apache", "Version", "2", "cc", "by", "nc", "-", ", ", " ", "\n", "é"]
    texts = list(corpus.values()) + [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["Under the MIT License under the mit-license. CC BY NC cc by-nc by nc", "cc by nc cc by nc"]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert all(found(r) == brute(texts[r.doc_id]) for r in rows)
    assert sum(len(r.places) for r in rows) > 100


@pytest.mark.parametrize(
    ("text", "postfix"),
    [
        ("MIT OR Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0 */", "mit apache-2.0 gpl-2.0-only classpath-exception-2.0 with and or"),
        ("(MIT OR BSD-3-Clause) AND ISC", "mit bsd-3-clause or isc and"),
        ("MIT OR )", "mit"),
        ("MIT AND", "mit"),
        ("MIT something", "mit"),
        ("(MIT OR", ""),
        ("", ""),
        ("((MIT))", "mit"),
    ],
)
def test_shunting_yard(text, postfix):
    assert " ".join(read_expression(text)) == postfix


def test_or_takes_the_milder_and_the_stricter_class():
    assert evaluate(read_expression("MIT OR GPL-3.0"))[1] == 1
    assert evaluate(read_expression("MIT AND GPL-3.0"))[1] == 3
    assert evaluate(read_expression("GPL-2.0 WITH Classpath-exception-2.0")) == (["gpl-2.0 with classpath-exception-2.0"], 2)


def test_tags_and_edge_cases(spark, odd_docs, no_docs, odd_texts):
    texts = ["// SPDX-License-Identifier: MIT OR Apache-2.0\ncode", "SPDX-License-Identifier: (", "Released under the MIT License."]
    rows = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert rows[0].labels == ["apache-2.0", "mit"] and rows[0].strictness == 1
    assert rows[1].labels == [] and rows[1].score == 0
    assert rows[2].labels == ["mit"] and 0.89 < rows[2].score < 0.91
    odd = licenses.scan_licenses(odd_docs).collect()
    assert len(odd) == len(odd_texts) + 2
    assert all(found(r) == brute(odd_texts[r.doc_id]) for r in odd if r.doc_id is not None)
    assert licenses.scan_licenses(no_docs).count() == 0


def test_plain_tags(spark):
    want = {
        "Package: x\nLicense: MIT OR Apache-2.0\n": ["apache-2.0", "mit"],
        "licence : GPL-3.0-only WITH Classpath-exception-2.0": ["gpl-3.0-only with classpath-exception-2.0"],
        "# LICENSE: (MPL-2.0 AND BSD-3-Clause) OR GPL-2+ */": ["bsd-3-clause", "gpl-2+", "mpl-2.0"],
        "License: MIT License": ["mit"],
        "License: MIT OR ISC.": ["isc", "mit"],
        "License: MIT OR the other one": ["mit"],
        "License: GPL-3.0-only WITH love": ["gpl-3.0-only"],
        "License: Ruby": ["ruby"],
        "License: Fair use is asked for": [],
        "License: see the file COPYING": [],
        "The license: mitigation of risks": [],
        "Sublicense: MIT, élicense: MIT": [],
        "License:\nMIT": [],
        "License: ": [],
        "SPDX-License-Identifier: Something-Else": ["something-else"],
    }
    texts = list(want)
    rows = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    assert {t: rows[i].labels for i, t in enumerate(texts)} == want
    assert all((rows[i].score > 0) == bool(want[t]) for i, t in enumerate(texts))
    assert rows[0].strictness == 1 and rows[0].expressions == ["mit apache-2.0 or"]


def test_many_places_in_one_text_take_linear_time():
    import time

    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase, label in licenses.BASE_PHRASES.items():
        automaton.add_word(f" {phrase} ", (f" {phrase} ", label))
    automaton.make_automaton()
    text = b"under the MIT license, cc-by-nc. " * 16000
    began = time.process_time()
    (row,) = licenses.scan_texts([text], automaton)
    assert time.process_time() - began < 2
    assert [p["word"] for p in row["places"][:4]] == [0, 4, 7, 11] and len(row["places"]) == 32000 and row["places"][-1]["word"] == row["n_words"] - 3
