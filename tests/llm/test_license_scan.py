from collections import Counter

import pytest

from scoutlab.llm.license_scan import MARKS, TEMPLATES, licenses, scan, template_table

GONE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", MARKS)


def normal(text):
    return (text or "").translate(GONE).split()


def shingles(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(text):
    """(license, first window, percent) from every window of every template, without hashing."""
    out = {}
    for name, notice in TEMPLATES:
        t = normal(notice)
        k = 5 if len(t) >= 5 else 3
        want = set(shingles(t, k))
        width = 4
        while width < 2 * len(want):
            width *= 2
        items = shingles(normal(text), k)
        for start in range(0, len(items), width // 2):
            share = 100 * len(want & set(items[start:start + width])) / len(want)
            if share >= 80:
                first, most = out.get(name, (start, 0))
                out[name] = (min(first, start), max(most, int(share)))
    return out


@pytest.fixture(scope="module")
def notices(spark):
    noise = [f"word{i * 7 % 101}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, " \t "), (3, "All rights reserved"), (4, "all rights are reserved")]
    for i, (_, notice) in enumerate(TEMPLATES):
        for j, at in enumerate((0, 1, 3, 17, 64, 150, 399)):
            rows.append((100 * (i + 1) + j, " ".join(noise[:at]) + f"\n{notice.upper() if j % 2 else notice} " + " ".join(noise[at:])))
        w = notice.split()
        rows.append((100 * (i + 1) + 50, " ".join([*noise[:30], *w[:-1], "changed", *noise[30:60]])))
        rows.append((100 * (i + 1) + 51, " ".join([*noise[:30], *w[:len(w) // 2], "changed", *w[len(w) // 2:], *noise])))
    rows += [(3, "All rights reserved"), (None, TEMPLATES[0][1])]
    return rows


def test_matches_brute_force(spark, notices):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in notices], "doc_id long, text string, license string, start int")
    want = {}
    for d, t in notices:
        for name, (first, share) in brute(t).items():
            a, b = want.get((d, name), (first, share))
            want[d, name] = (min(a, first), max(b, share))
    got = {(r.doc_id, r.license): (r.first_word, r.contained) for r in licenses(docs).collect()}
    assert got == want
    assert all(any((100 * (i + 1) + j, n) in got for j in range(7)) for i, (n, _) in enumerate(TEMPLATES))


def test_limits_and_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses(empty).count() == 0
    with pytest.raises(ValueError):
        scan(empty, template_table(spark, [("long", " ".join(f"w{i}" for i in range(60)))])).count()
    same = spark.createDataFrame([(1, TEMPLATES[0][1])], "doc_id long, text string")
    assert Counter(r.license for r in licenses(same).collect()) == Counter([TEMPLATES[0][0]])


def test_bodies_and_variants(spark):
    texts = dict(TEMPLATES)  # the last of a name: the whole text where there is one
    apache = texts["Apache-2.0"].split()
    cases = [
        ("Apache-2.0", " ".join(apache[:1300])), ("GPL-3.0", texts["GPL-3.0"]), ("CC0-1.0", "a b c " + texts["CC0-1.0"]), ("MPL-2.0", texts["MPL-2.0"]),
        ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to us."),
        ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
        ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                "provided that the above copyright notice and this permission notice appear in all copies."),
        ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is here"),
    ]
    half = " ".join(apache[:len(apache) // 2])
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)] + [(99, half)], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in licenses(docs).collect()}
    assert {(i, n) for i, (n, _) in enumerate(cases)} <= got and not [g for g in got if g[0] == 99]
