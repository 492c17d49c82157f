import re

from tapespark.llm import licences, queries


def test_query_finds_every_notice_of_the_table(spark):
    path = "/root/testdata/sf0.01"
    told = {"mit": "MIT License", "apache": "Apache License", "gpl": "GNU General Public", "cc-by-nc": "CC BY-NC", "reserved": "All rights reserved"}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_licences"](spark, path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = sorted(family for family, words in told.items() if words in texts[r.doc_id])
        assert r.licences == ",".join(want), r.doc_id
        for span in filter(None, r.spans.split(",")):
            family, start, end = span.split(":")
            assert re.search(told[family], texts[r.doc_id][int(start):int(end)])


def test_families_unknown_and_none(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, notice, "apache"), (2, f"é words here.\n  {notice}\nand more", "apache"), (3, "Licensed under the Frobnicate Terms 7.", "unknown"),
        (4, "She lost her licence to drive on the way home last night.", None), (5, None, ""), (6, "", ""), (7, "plain words " * 20_000, ""),
        (1, notice, "apache"), (None, "All rights reserved.", "reserved"), (8, f"{notice} Released under the MIT License.", "apache,mit"),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, licences string, notices int")
    got = licences.report(docs).collect()
    want = {d: w for d, _, w in rows}
    assert len(got) == len(rows)
    for r in got:
        if want[r.doc_id] is not None:
            assert r.licences == want[r.doc_id], r
        else:
            assert r.licences in ("", "unknown")
    assert next(r for r in got if r.doc_id == 2).spans == f"apache:16:{16 + len(notice)}"
    assert licences.report(docs.limit(0)).count() == 0


def test_notices_without_cue_and_over_two_lines(spark):
    rows = [
        (1, "Released under Apache 2.0.", "apache"), (2, "Released under the BSD 3-Clause.", "bsd"),
        (3, "Permission is granted, free of charge, to any person obtaining a copy of this software", "mit"),
        (4, "é words\nLicensed under the Apache\nLicense, Version 2.0.\n\nmore words", "apache"),
        (5, "plain words\nover two lines.\n\nand more", ""), (6, "Licensed under the Apache\n\nLicense, Version 2.0.", "unknown"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, want string")
    got = {r.doc_id: r for r in licences.report(docs).collect()}
    assert {d: r.licences for d, r in got.items()} == {d: w for d, _, w in rows}
    assert got[4].spans == "apache:8:55"


def test_hints_leave_out_nothing_that_can_be_confirmed():
    draw = licences.np.random.default_rng(3)
    for templates in licences.TEMPLATES.values():
        for t in templates:
            words = sorted(set(licences.words_of(t)))
            least = next(m for m in range(1, len(words) + 1) if m / len(words) >= licences.CONFIRM)
            for _ in range(50):
                assert licences.hinted(" ".join(draw.choice(words, least, replace=False)))


NOTICES = {
    "mit": licences.TEMPLATES["mit"][3:7], "apache": licences.TEMPLATES["apache"][2:6], "gpl": licences.TEMPLATES["gpl"][1:2] + licences.TEMPLATES["gpl"][3:6],
    "bsd": licences.TEMPLATES["bsd"][1:6], "mpl": (licences.TEMPLATES["mpl"][0], licences.TEMPLATES["mpl"][2]),
}


def test_whole_notices_wrapped_anywhere():
    draw = licences.np.random.default_rng(5)
    model = licences.fit([f"plain words number {k} of a text" for k in range(400)])
    for family, paragraphs in NOTICES.items():
        for paragraph in paragraphs:
            for width in (0, 5, 9, 14):
                words = paragraph.split()
                cuts = [k for k in range(1, len(words)) if width and k % width == int(draw.integers(width))]
                text = " ".join(("\n" if k in cuts else "") + w for k, w in enumerate(words)).replace(" \n", "\n")
                found = licences.notices_in(f"Some words before.\n\n{text}\n\nand after.", model, {})
                assert {n[2] for n in found if n[2] != "unknown"} == {family}, (family, text)


def test_identifiers_and_near_families():
    model = licences.fit([f"plain words number {k} of a text" for k in range(400)])
    cases = {
        "SPDX-License-Identifier: MIT": "mit", "// SPDX-License-Identifier: GPL-3.0-or-later": "gpl", "SPDX-License-Identifier: Apache-2.0": "apache",
        "Licensed under the GNU Affero General Public License, version 3.": "agpl",
        "Licensed under the GNU Lesser General Public License, version 2.1.": "lgpl",
        "Licensed under the GNU General Public License, version 3.": "gpl",
    }
    for text, family in cases.items():
        assert [n[2] for n in licences.notices_in(text, model, {})] == [family], text
    for text in (
        "Many people ask which licence they should choose for their work.", "The driving licence office is open on Mondays.",
        "Free software is a matter of liberty, not price.", "He redistributed the copies among his friends.",
    ):
        assert all(n[2] == "unknown" for n in licences.notices_in(text, model, {})), text
