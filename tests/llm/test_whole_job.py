"""Cases where an operator once did less than its whole job."""

import itertools
import random
from re import _constants, _parser

import pytest
from roadbed.llm import licenses, line_dedup

from .test_corpus_operators import brute_roots, edited, full_distance


def test_short_lines_have_classes(spark):
    draw = random.Random(13)
    lines = ["".join(draw.choice("abcdef") for _ in range(n)) for n in range(1, 40) for _ in range(2)]
    lines += [edited(draw.choice(lines[10:]), draw, draw.randrange(1, 3)) for _ in range(150)]
    rows = [(i, "\n".join(draw.choice(lines) for _ in range(4))) for i in range(120)] + [(200, "\n  \nx\nx"), (201, "x\r")]
    places = [(d, n, x.strip(" \t\r")) for d, t in rows for n, x in enumerate(t.split("\n"))]
    places = [p for p in places if p[2]]
    allowed = lambda a, b: sum(min(len(a), len(b)) >= n for n in (12, 24))
    distinct = sorted({p[2] for p in places})
    links = [(a, b) for a, b in itertools.combinations(distinct, 2) if full_distance(a, b) <= allowed(a, b)]
    assert sum(len(a) < 24 for a, _ in links) > 5
    roots, head = brute_roots(distinct, links), {}
    for d, n, line in places:
        head.setdefault(roots[line], (d, n))
    want = sorted((d, n, *head[roots[line]]) for d, n, line in places)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.line_classes(docs).select("doc_id", "line_no", "class_doc", "class_line").collect()
    assert sorted(map(tuple, got)) == want
    left = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert all(left[d].split("\n").count(line) >= 1 for d, n, line in places if d in left and head[roots[line]] == (d, n))
    assert 201 not in left


def test_lines_of_its_own_stay_beside_boilerplate(spark):
    common = [f"boilerplate {chr(97 + i) * 5} line, stated at some length" for i in range(20)]
    rows = [(1, "\n".join(common)), (2, "\n".join([*common, "a line that stands nowhere else"])), (3, "\n".join(common) + "\n \n")]
    left = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.text for r in left} == {1: rows[0][1], 2: "a line that stands nowhere else"}


def examples(parsed):
    """Some texts that match: every branch, options left out and taken."""
    out = [""]
    for kind, value in parsed:
        if kind is _constants.LITERAL:
            more = [chr(value)]
        elif kind is _constants.BRANCH:
            more = [x for branch in value[1] for x in examples(branch)[:2]]
        elif kind is _constants.SUBPATTERN:
            more = examples(value[-1])
        elif kind is _constants.MAX_REPEAT:
            more = examples(value[2]) + [""] * (value[0] == 0)
        elif kind is _constants.IN:
            more = [chr(value[0][1]) if value[0][0] is _constants.LITERAL else "1"]
        else:
            more = [""]
        size = max(len(out), len(more))
        out = [out[i % len(out)] + more[i % len(more)] for i in range(size)]
    return out


def test_license_gates_lose_no_rule(spark, monkeypatch):
    texts = [x for _, own in licenses.rules() for rule in own for x in examples(_parser.parse(rule[0]))]
    texts = sorted({form.format(t.strip()) for t in texts for form in ("{}", "_{}_", "x. {}, y")})
    named = {"_CC BY-NC_": "cc-by-nc", "Released under MIT.": "mit", "licensed under the LGPLv3": "lgpl-3", "AGPLv3": "agpl-3",
             "SPDX-License-Identifier: 0BSD": "bsd-0", "FreeBSD license": "bsd-2", "SPDX-License-Identifier: MPL-2.0": "mpl-2",
             "SPDX-License-Identifier: OFL-1.1": "ofl-1.1", "Distributed under BSD": "bsd"}
    docs = spark.createDataFrame(list(enumerate([*named, *texts])), "doc_id bigint, text string").repartition(8).cache()
    rows = sorted(licenses.scan_licenses(docs).collect())
    assert [r.labels for r in rows[: len(named)]] == list(named.values())
    assert all(r.labels for r in rows)
    monkeypatch.setattr(licenses, "_GATE", "")
    monkeypatch.setattr(licenses, "_needed", lambda pattern: [" "])
    assert sorted(licenses.scan_licenses(docs).collect()) == rows


def near_copies(n):
    """Lines that all share most segments and are two edits from one, and four or fewer from each other."""
    draw = random.Random(17)
    base = "a template line that hundreds of documents hold with a letter or two changed"
    return [base, *sorted({edited(base, draw, draw.choice([1, 2])).strip() for _ in range(n)} - {base})]


@pytest.mark.parametrize("cell", [1000, 40])
def test_crowded_lines_give_a_forest_and_exact_counts(spark, monkeypatch, cell):
    monkeypatch.setattr(line_dedup, "CELL", cell)
    lines = near_copies(500)
    rows = [(i, line) for i, line in enumerate(lines)]
    links = [(a, b) for a, b in itertools.combinations(lines, 2) if line_dedup.edit_distance(a, b) is not None]
    degree = {line: 0 for line in lines}
    for pair in links:
        for line in pair:
            degree[line] += 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = line_dedup.line_classes(docs).collect()
    assert {r.doc_id: r.n_links for r in got} == {i: degree[line] for i, line in rows}
    assert {r.class_doc for r in got} == {0} and len(links) > 10 * len(lines)
    forest, _ = line_dedup.line_links(line_dedup.split_lines(docs))
    # three segments and their shifts: some keys a line, each cell with a forest of its own
    assert cell < 1000 or forest.count() < 12 * len(lines) < len(links)
