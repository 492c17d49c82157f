import hashlib
import re

import pytest

from tapespark.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "nothing here", "a@b.cd_x@y.zz, é mail me@site.example.org.",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0255", "é 4111 1111 1111 1111; 4111-1111-1111-1112",
    "+1 (269) 555-3296 4524132264652876 and +12", "+4111111111111111", "x@y.z " * 3000,
    "a" * 50_000, "1" * 50_000, "1.1." * 9000, "a@b" + ".c" * 20_000, "IBAN GB82 WEST 1234 5698 7654 32.",
    "GB83 WEST 1234 5698 7654 32", "a@b.c a@b.c",
]


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def told(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, text, "x") for k, text in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, TEXTS[4], None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kind string")


def test_spans_match_a_plain_search(docs):
    rows = pii.report(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = TEXTS[4 if row.doc_id is None else row.doc_id]
        spans = brute(text)
        assert row.base_sha256 == hashlib.sha256(told(spans).encode()).hexdigest(), row.doc_id
        assert [row[f"n_{kind}"] for kind in PATTERNS] == [sum(s[2] == kind for s in spans) for kind in PATTERNS]
        base = [s for s in row.spans.split(",") if s and not s.startswith("iban")]
        assert ",".join(base) == told(spans)


def test_account_numbers_need_their_checksum_and_words_raise_scores(docs):
    rows = {r.doc_id: r for r in pii.report(docs).collect()}
    assert (rows[13].n_iban, rows[14].n_iban) == (1, 0)
    assert rows[13].top_score == 1.0
    assert rows[2].top_score is None


def test_account_numbers_end_where_their_country_says(spark):
    german, british, unlisted = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "ZZ65 0000 1234 5678 9012"
    assert int("".join(str(int(c, 36)) for c in (unlisted[4:] + unlisted[:4]).replace(" ", ""))) % 97 == 1
    cases = [
        ("IBAN {} Please pay", [german]), ("{} AND x", [german.replace(" ", "")]), ("{} 5 EUR", [german]),
        ("{} {} BY 1 MAY", [german, british]), ("{} OR {}", [british, german]), ("REF AB12 {} NOW", [british]),
        ("{} AND MORE", [unlisted]), ("{} Please", [unlisted]), ("{}.", [unlisted]), ("é {} {} X", [unlisted, german]),
        ("DE89 3704 0044 0532 0130 01 AND", []), ("DE89370400440532013000X", []),
    ]
    docs = spark.createDataFrame([(k, t.format(*n)) for k, (t, n) in enumerate(cases)], "doc_id long, text string")
    for row in pii.report(docs).collect():
        told, numbers = cases[row.doc_id]
        spans = [s.split(":") for s in row.spans.split(",") if s.startswith("iban")]
        assert [told.format(*numbers)[int(a):int(b)] for _, a, b in spans] == numbers, row
    for row in pii.redact(docs).collect():
        told, numbers = cases[row.doc_id]
        assert row.text == told.format(*["[IBAN]"] * len(numbers))


def test_redaction_leaves_nothing_and_keeps_columns(docs):
    rows = pii.redact(docs).collect()
    assert len(rows) == docs.count() and rows[0].asDict().keys() == {"doc_id", "text", "kind"}
    by_id = {r.doc_id: r.text for r in rows}
    assert by_id[0] is None and by_id[2] == "nothing here"
    assert by_id[3] == "[EMAIL][EMAIL], é mail [EMAIL]."
    assert by_id[5].startswith("é [CARD]; 4111-1111-1111-1112")
    assert by_id[13] == "IBAN [IBAN]."
    assert not any(brute(r.text) for r in rows)


def test_empty_table_and_no_python_in_the_plan(docs):
    assert pii.report(docs.limit(0)).count() == 0
    assert not re.search("Python|Arrow|Pandas", pii.report(docs)._jdf.queryExecution().executedPlan().toString())
