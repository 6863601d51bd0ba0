import math
from collections import Counter

import pytest

from saleslake.llm import licenses as lic
from saleslake.llm.queries import op7_license_scan

SCHEMA = "path string, text string, dir string, row int"
APACHE, MIT = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
FILES = [
    ("LICENSE", APACHE), ("a.py", "code"), ("src/b.py", "x = 1"), ("src/lib/COPYING.txt", f"prose\n{MIT}\nmore"),
    ("src/lib/c.py", "y"), ("src/lib/deep/er/d.py", None), ("src/lib/e.py", f"# {APACHE}"), ("src/lib/c.py", "y"),
    ("other/NOTICE", ""), ("other/f", "nothing of the kind here"), (None, MIT), (None, "code"),
]


def test_own_and_inherited(spark):
    files = spark.createDataFrame([(*f, "", 1) for f in FILES], SCHEMA)
    rows = lic.inherit(lic.own_licences(files)).collect()
    got = Counter((r.path, r.own_licence, r.licence, r.licence_from) for r in rows)
    a, m = "Apache-2.0", "MIT"
    assert got == Counter(
        [
            ("LICENSE", a, a, "LICENSE"), ("a.py", None, a, "LICENSE"), ("src/b.py", None, a, "LICENSE"),
            ("src/lib/COPYING.txt", m, m, "src/lib/COPYING.txt"), ("src/lib/c.py", None, m, "src/lib/COPYING.txt"),
            ("src/lib/c.py", None, m, "src/lib/COPYING.txt"), ("src/lib/deep/er/d.py", None, m, "src/lib/COPYING.txt"),
            ("src/lib/e.py", a, a, "src/lib/e.py"), ("other/NOTICE", None, a, "LICENSE"), ("other/f", None, a, "LICENSE"),
            (None, m, m, None), (None, None, None, None),
        ]
    )
    assert lic.inherit(lic.own_licences(files.limit(0))).count() == 0
    clash = files.withColumnRenamed("dir", "similarity").selectExpr("*", "1 AS licence")
    own = lic.own_licences(clash)
    assert own.columns == [*clash.columns, "own_licence", "similarity_1"]
    found = lic.inherit(own, similarity="similarity_1")
    assert found.columns == [*own.columns, "licence_1", "licence_from"]
    assert Counter((r.path, r.own_licence, r.licence_1, r.licence_from) for r in found.collect()) == got


def test_cosine():
    lines, counts = 100, {"license": 9, "mit": 3}
    matcher = lic.Matcher({"MIT": MIT, "X": "license x"}, lines, counts)
    weight = lambda w: math.log(101 / (1 + counts.get(w, 0))) + 1
    seen = {w: weight(w) for w in ("the", "mit", "license")} | {"zzz": math.log(101 / 2) + 1}
    want = {w: weight(w) for w in ("released", "under", "the", "mit", "license")}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    cosine = sum(seen[w] * want[w] for w in seen if w in want) / norm(seen) / norm(want)
    assert matcher.best("the MIT license, zzz!") == ("MIT", pytest.approx(cosine))
    assert matcher.best("nothing") == (None, 0.0)


def test_query_finds_every_licence_line(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op7_license_scan(spark, sf).collect()}
    assert set(rows) == set(texts)
    for i, text in texts.items():
        assert (rows[i].own_licence is not None) == any("icensed under" in x or "under the MIT" in x for x in text.split("\n"))


def test_other_words_have_their_true_frequencies(spark):
    """Words beside a notice that many lines have must not dilute it; all cosines against a brute force."""
    notice = f"Copyright 2020 Acme Widget Holdings Inc. Springfield Illinois. {MIT}"
    common = ["copyright 2020 acme", "widget holdings inc springfield illinois", "the public work is licensed", "plain words"]
    texts = [notice, notice, "some words\nreleased under the mit license by acme acme", None, *["\n".join(common)] * 400]
    lines = [set(lic.terms(x)) for t in texts for x in (t or "").split("\n")]
    counts = Counter(w for x in lines for w in x)
    weight = lambda w: math.log((1 + len(lines)) / (1 + counts[w])) + 1
    vector = lambda t: {w: n * weight(w) for w, n in lic.terms(t).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def brute(text):
        found = (None, 0.0)
        for part in [*(text or "").split("\n"), text or ""]:
            v = vector(part)
            for name, template in sorted(lic.TEMPLATES.items()):
                t = vector(template)
                value = sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t) if v else 0
                if value > found[1] + 1e-12:
                    found = (name, value)
        return found if found[1] >= lic.THRESHOLD else (None, 0.0)

    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k1 int, text string").repartition(4)
    got = {r.k1: (r.own_licence, r.similarity) for r in lic.own_licences(docs).collect()}
    want = {i: brute(t) for i, t in enumerate(texts)}
    assert {i: name for i, (name, _) in got.items()} == {i: name for i, (name, _) in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1]) for i in want)
    once = {w: n for w, n in counts.items() if w in lic.vocabulary(lic.TEMPLATES)}
    assert got[0][0] == "MIT" and lic.Matcher(lic.TEMPLATES, len(lines), once).best(notice)[1] < lic.THRESHOLD
