import random
import re

from helpers import awkward, prose, table  # noqa: F401

from lakeops.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text):
    words = words_of(text)
    base = sorted((label, i) for phrase, label in BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
    joined, found = f" {' '.join(words)} ", []
    for r in licenses.rules():
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", joined):
            start = joined[:m.start()].count(" ") - 1
            found.append((start, -(start + len(m[0].split())), -r.priority, r.label, r.confidence))
    kept = []
    for start, end, priority, label, confidence in sorted(found):
        if kept and start < -kept[-1][1]:
            if -end > -kept[-1][1] and priority < kept[-1][2]:
                kept[-1] = (start, end, priority, label, confidence)
        else:
            kept.append((start, end, priority, label, confidence))
    return len(words), base, [(s, -e, label) for s, e, _, label, _ in kept]


CASES = [
    "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0 (the License); see http://www.apache.org/licenses/LICENSE-2.0",
    "mit license mit license MIT-LICENSE submit license mit licensed", "SPDX-License-Identifier: Apache-2.0\nAll rights reserved", "ccby cc by cc  -- by CCBY-SA",
    "gnu gnu general public license general public license 2", "GNU Lesser General Public License v2.1 or GNU Affero General Public License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "BSD 3-Clause; CC0 1.0 Universal; public domain",
    "dedicated to the public domain; CC BY-SA 4.0 / CC-BY-4.0", "mit license ümit license mit licenseé", "apache license " * 300, "MİT license"]


def check(spark, rows, table):  # noqa: F811
    got = licenses.scan_licenses(table(rows, ["n_words", "base", "detections"])).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, sorted((b.label, b.start) for b in r.base), [(d.start, d.end, d.label) for d in r.detections]) for r in got)
    assert found == sorted((-1 if i is None else i, *brute(t)) for i, t in rows)


def test_texts_match_brute_force(spark, table, awkward):
    rng = random.Random(6)
    names = [re.sub(r"\(\?:|\)\??|\[cs\]|\?", "", n[2]).replace("|", " ") for n in licenses.NAMES]
    mixed = [(500 + i, " ".join(rng.choice([rng.choice(names), rng.choice(CASES[:12]), prose(i, 3), "licensed under the terms of the", "license"]) for _ in range(8))) for i in range(80)]
    check(spark, awkward + [(100 + i, c) for i, c in enumerate(CASES)] + mixed, table)


def test_specific_names_win_over_what_they_contain(spark, table):
    rows = licenses.scan_licenses(table([(i, c) for i, c in enumerate(CASES)])).collect()
    labels = {r.doc_id: [d.label for d in r.detections] for r in rows}
    assert labels[0] == ["mit"] and labels[1] == ["gpl-3.0"] and labels[2] == ["cc-by-nc-4.0"]
    assert labels[5][0] == "apache-2.0" and "lgpl-2.1" in labels[8] and "agpl" in labels[8]


def test_there_are_hundreds_of_rules_and_each_keyword_is_in_its_matches():
    known = licenses.rules()
    assert len(known) >= 200
    for r in known:
        re.compile(r.pattern)


def test_no_python_and_no_shuffle(spark, table):
    plan = licenses.scan_licenses(table([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


def test_empty_table(spark, table):
    assert licenses.scan_licenses(table([])).collect() == []


def test_gate_and_keywords_let_every_match_through(spark):
    known = licenses.rules()
    names = [re.sub(r"\(\?:([^()|]*)\|[^()]*\)", r"\1", n[2]) for n in licenses.NAMES + licenses.SIGNS]
    plain = [re.sub(r"\(\?:|\)|\?|\[cs\]|\[1-4\]|\[abc\]|\[123\]|\[05\]|\[01\]", lambda m: {"[cs]": "c", "[1-4]": "4", "[abc]": "b", "[123]": "3", "[05]": "0", "[01]": "1"}.get(m[0], ""), n) for n in names]
    gate = re.compile(licenses._gate(known))
    for text in plain + [f"SPDX-License-Identifier: {n[0]}" for n in licenses.NAMES]:
        joined = f" {' '.join(words_of(text))} "
        hit = [r for r in known if re.search(f"(?<= )(?:{r.pattern})(?= )", joined)]
        for r in hit:
            assert f" {r.keyword}" in joined, (r, text)
            assert gate.search(text.upper().replace(" ", " -\n")), text


def expand(pattern):
    """Every text that a rule's pattern matches."""
    import itertools
    from re import _constants as c
    from re import _parser

    def of(part):
        return ["".join(x) for x in itertools.product(*map(one, part))]

    def one(item):
        kind, value = item
        if kind is c.LITERAL:
            return [chr(value)]
        if kind is c.IN:
            return [x for k, v in value for x in (map(chr, range(v[0], v[1] + 1)) if k is c.RANGE else [chr(v)])]
        if kind is c.BRANCH:
            return [x for part in value[1] for x in of(part)]
        if kind is c.SUBPATTERN:
            return of(value[-1])
        assert kind is c.MAX_REPEAT and value[:2] == (0, 1), item
        return ["", *of(value[2])]

    return of(_parser.parse(pattern))


def test_every_alternative_of_every_pattern_has_its_keyword():
    known = licenses.rules()
    gate = re.compile(licenses._gate(known))
    plain = [(k, p) for _, k, p in licenses.NAMES + licenses.SIGNS] + [(r.keyword, r.pattern) for r in licenses._identifiers()]
    for keyword, pattern in plain:
        for text in expand(pattern):
            assert re.fullmatch(pattern, text)
            assert f" {keyword}" in f" {text} ", (keyword, text)
            assert gate.search(text.upper().replace(" ", "-\n")), text


def test_names_alone_are_found(spark, table):  # noqa: F811
    want = {"Under the FreeBSD license.": "bsd-2-clause", "0BSD License": "bsd-0-clause", "the Do What The Fuck You Want To Public License": "wtfpl",
            "SPDX-License-Identifier: 0BSD": "bsd-0-clause", "SPDX-License-Identifier: BSL-1.0": "boost-1.0", "SPDX-License-Identifier: PSF-2.0": "python-2.0"}
    rows = licenses.scan_licenses(table(list(enumerate(want)))).collect()
    assert {r.doc_id: [d.label for d in r.detections] for r in rows} == {i: [label] for i, label in enumerate(want.values())}


def brute_resolved(hits):
    left, kept = list(hits), []
    while left:
        outer = [x for x in left if not any(y[0] <= x[0] and x[1] <= y[1] and y[1] - y[0] > x[1] - x[0] for y in left)]
        best = min(outer, key=lambda x: (-x[2], x[0] - x[1], x[0], x[3]))
        kept.append(best)
        left = [x for x in left if x[0] >= best[1] or x[1] <= best[0]]
    return sorted(kept)


def test_overlaps_are_resolved_as_by_brute_force(spark):
    rng = random.Random(12)
    cases = [[(1, 4, 1, "a"), (2, 3, 2, "b"), (3, 5, 9, "c")]]
    for _ in range(300):
        hits = set()
        for _ in range(rng.randint(0, 12)):
            start = rng.randrange(30)
            hits.add((start, start + rng.randint(1, 8), rng.randrange(4), rng.choice("abc")))
        cases.append(sorted(hits))
    frame = spark.createDataFrame([(i, [(s, e, p, x, 0.5) for s, e, p, x in hits]) for i, hits in enumerate(cases)],
                                  f"id int, _all array<{licenses._HIT}>")
    for r in frame.selectExpr("id", f"{licenses._RESOLVE} AS kept").collect():
        assert [(k.start, k.end, k.priority, k.label) for k in r.kept] == brute_resolved(cases[r.id]), cases[r.id]
    assert {x[3] for x in brute_resolved(cases[0])} == {"b", "c"}
