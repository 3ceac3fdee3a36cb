import os
import re
import sys

sys.path.insert(0, os.path.dirname(__file__))
from edge_cases import edge_docs, empty_docs

from ledgerline.llm import license_scan, queries

WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def grams(text, k):
    words = WORD.findall(text.lower())
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def telling_grams():
    """By template: its n-grams with a number that no other license has."""
    known = {}
    for name, texts in license_scan.TEMPLATES.items():
        for t in texts:
            k = min(5, len(WORD.findall(t.lower())))
            known[name, t] = set(grams(t, k))
    numbered = {key: {g for g in own if any(w.isdigit() for w in g)} for key, own in known.items()}
    return {key: {g for g in own if not any(g in o for (n, _), o in known.items() if n != key[0])}
            or own for key, own in numbered.items()}


TELLING = telling_grams()


def settled(out):
    """Of overlapping places of two licenses the stronger, or the one that holds the
    other; conditions that another license shares are named like it."""
    kept = [m for m in out if not any(
        o[0] != m[0] and o[1] < m[1] + m[2] and m[1] < o[1] + o[2]
        and (o[3] > m[3] or o[3] == m[3] and o[1] <= m[1] and o[1] + o[2] >= m[1] + m[2]
             and o[2] > m[2]) for o in out)]
    return sorted(("BSD-3-Clause" if m[0] == "BSD-2-Clause" and any(
        o[0] == "BSD-3-Clause" and m[1] <= o[1] <= m[1] + m[2] + 200 for o in kept) else m[0],
        *m[1:]) for m in kept)


def brute_force(text):
    return sorted({m[0] for m in all_places(text)})


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op1_license_scan(spark, sf).collect()
    got = {r.doc_id: r.licenses for r in rows}
    assert got == {i: brute_force(t or "") for i, t in docs.items()}
    assert sum(map(bool, got.values())) > 20


def test_long_templates_anywhere_and_with_changes():
    scanner = license_scan.Scanner()
    for name, texts in license_scan.TEMPLATES.items():
        for t in texts:
            for before in (0, 1, 7, 100):
                text = "lorem ipsum " * before + t.upper() + " dolor sit" * 30
                assert name in {m[0] for m in scanner.scan([text])[0]}
    mit = license_scan.TEMPLATES["MIT"][2]
    found = scanner.scan([mit.replace("without limitation", "with limits")])[0]
    assert [m[0] for m in found] == ["MIT"] and 0.8 <= found[0][3] < 1
    assert scanner.scan([mit[:len(mit) // 2]]) == [[]]


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark)
    assert all(r.n_matches == 0 and r.best_containment == 0
               for r in license_scan.licenses(docs).collect())
    assert license_scan.licenses(docs).count() == docs.count()
    assert license_scan.licenses(empty_docs(spark)).collect() == []


def all_places(text):
    """(license, first word, words, containment) of every place, by going
    through the n-grams of all verified windows."""
    out = []
    for name, texts in license_scan.TEMPLATES.items():
        for t in texts:
            k = min(5, len(WORD.findall(t.lower())))
            want, have = set(grams(t, k)), grams(text, k)
            step = 1 << (len(want) - 1).bit_length()
            at = sorted({j for i in range(0, len(have), step)
                         if len(want & set(have[i:i + 2 * step])) / len(want) >= 0.8
                         for j in range(i, min(i + 2 * step, len(have))) if have[j] in want})
            groups = []
            for j in at:
                seen = {have[i] for i in groups[-1]} if groups else set()
                again = len(seen) / len(want) >= 0.8 and have[j] in seen
                if not groups or again or j - groups[-1][-1] >= 2 * step:
                    groups.append([])
                groups[-1].append(j)
            for g in groups:
                share = len({have[i] for i in g}) / len(want)
                here = {have[i] for i in g}
                if share >= 0.8 and (not TELLING[name, t] or here & TELLING[name, t]):
                    out.append((name, g[0], g[-1] - g[0] + k, share))
    return settled(out)


def places(scanner, text):
    return sorted(scanner.scan([text])[0])


def test_every_place_of_a_template_counts():
    scanner = license_scan.Scanner()
    two, three = license_scan.TEMPLATES["GPL-2.0"][1], license_scan.TEMPLATES["GPL-3.0"][1]
    text = two + " lorem ipsum" * 200 + " " + three.replace("redistribute it", "copy it")
    assert {m[0] for m in places(scanner, text)} == {"GPL-2.0", "GPL-3.0"}
    assert places(scanner, text) == all_places(text)
    mit = license_scan.TEMPLATES["MIT"][2]
    for between in (" ", " x " * 3, " x " * 70, " x " * 500):
        text = between.join([mit] * 4 + ["All rights reserved"] * 3)
        assert [m[0] for m in places(scanner, text)] == ["MIT"] * 4 + ["proprietary"] * 3
        assert places(scanner, text) == all_places(text)


def test_places_of_the_fixture_texts(spark):
    texts = [r.text or "" for r in
             spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    scanner = license_scan.Scanner()
    assert [places(scanner, t) for t in texts] == [all_places(t) for t in texts]


def test_versions_have_their_own_names():
    scanner, gpl = license_scan.Scanner(), license_scan.TEMPLATES["GPL-3.0"][1]
    for text, name in [
            ("licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
            ("licensed under the GNU General Public License, version 1", "GPL-1.0"),
            (gpl.replace("GNU", "GNU Affero"), "AGPL-3.0"),
            (gpl.replace("GNU", "GNU Lesser"), "LGPL-3.0")]:
        assert {m[0] for m in places(scanner, "lorem " * 9 + text + " ipsum" * 9)} == {name}


BSD = license_scan.TEMPLATES["BSD-2-Clause"][0]
CLAUSE = license_scan.TEMPLATES["BSD-3-Clause"][0]


def test_names_that_differ_by_a_clause_a_version_or_an_identifier():
    scanner = license_scan.Scanner()
    middle = " 1. Redistributions of source code must retain the above copyright notice. " * 3
    cases = [
        (BSD + middle + "This software is provided by the authors", {"BSD-2-Clause"}),
        (BSD + middle + CLAUSE, {"BSD-3-Clause"}),
        (BSD + " word" * 400 + CLAUSE, {"BSD-2-Clause", "BSD-3-Clause"}),
        ("licensed under the GNU Lesser General Public License, version 2 here", set()),
        ("Distributed under the Boost Software License, Version 1.0.", {"BSL-1.0"}),
        ("Licensed under CC BY-NC-SA 4.0", {"CC-BY-NC-SA-4.0"}),
        ("// SPDX-License-Identifier: MIT", {"MIT"}),
        ("// SPDX-License-Identifier: MIT-0", {"MIT-0"}),
        ("# SPDX-License-Identifier: GPL-2.0-only", {"GPL-2.0"}),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", {"LGPL-2.1"}),
        ("SPDX-License-Identifier: BSD-2-Clause", {"BSD-2-Clause"}),
        ("GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n Copyright (C)", {"GPL-3.0"}),
        ("Apache License\nVersion 2.0, January 2004\nhttp://www", {"Apache-2.0"}),
    ]
    for text, names in cases:
        for before in ("", "lorem ipsum " * 50):
            got = places(scanner, before + text + " dolor sit" * 20)
            assert {m[0] for m in got} == names, text
            assert got == all_places(before + text + " dolor sit" * 20)


def test_long_texts_in_chunks_give_the_same_places(monkeypatch):
    notices = [t for texts in license_scan.TEMPLATES.values() for t in texts]
    text = " ".join(n + " lorem ipsum" * (i % 90) for i, n in enumerate(notices * 2))
    whole = license_scan.Scanner().scan([text])[0]
    monkeypatch.setattr(license_scan, "CHUNK", 128)
    monkeypatch.setattr(license_scan, "PIECE", 1000)
    assert license_scan.Scanner().scan(["a", text, "b"])[1] == whole and len(whole) > 60


def test_the_query_returns_the_places(spark):
    rows = queries.op1_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert all(r.n_matches == len(r.matches) for r in rows) and sum(r.n_matches for r in rows) > 0
