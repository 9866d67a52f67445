import re

from tessera.llm import pii

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c)
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, r in RULES.items() for m in re.finditer(r, text or "") if passes(k, m.group())]


PIECES = ["a@b.c", "_d@e.f", "@", ".", "1", "2", "255", "256", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (", "555) ", "-", " ", "é", "x",
          ".com", "1.2.3.4", "0001", "\n", "(", ")", "𝒳", "%", "7", "00"]


def test_base_spans_equal_brute_force(spark, corpus, rng):
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(600)] + ["1.2.3.4 " * 1500, *corpus.values()]
    rows = pii.base_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(s) for s in r.base] == brute(texts[r.doc_id])


def test_method_adds_spans_and_keeps_base_ones(spark):
    texts = [
        "SSN: 123-45-6789, born 01/02/1980. Contact Mr. John Smith, call 555-123-4567. IBAN DE89 3704 0044 0532 0130 00.",
        "My ssn 219-09-9999 is here, a@b.de too.",
        "see version 12/13/2001 and order 987-65-4321 of the build",
        "nothing at all",
    ] * 3
    rows = {r.doc_id: r for r in pii.find_private(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()}
    found = {i: {(s.kind, texts[i][s.start : s.end]) for s in r.spans} for i, r in rows.items()}
    assert ("ssn", "123-45-6789") in found[0] and ("iban", "DE89 3704 0044 0532 0130 00") in found[0]
    assert ("ssn", "219-09-9999") in found[1] and ("email", "a@b.de") in found[1]
    assert found[3] == set()
    assert all(r.spans[: len(r.base)] == r.base for r in rows.values())


def test_em_finds_the_reliable_labeler():
    patterns = [((1, 0, 1, 0, 0), 80.0), ((1, 0, 0, 0, 0), 20.0), ((-1, 0, 0, 0, -1), 90.0), ((1, 0, 0, 0, -1), 10.0)]
    p, rates = pii.em(patterns)
    assert p[0] > 0.9 and p[2] < 0.1
    assert rates[0][1][2] > rates[0][0][2]


def test_edge_cases(odd_docs, no_docs, odd_texts):
    rows = pii.find_private(odd_docs).collect()
    assert len(rows) == len(odd_texts) + 2
    for r in rows:
        if r.doc_id is not None:
            assert [tuple(s) for s in r.base] == brute(odd_texts[r.doc_id])
    assert pii.find_private(no_docs).count() == 0
