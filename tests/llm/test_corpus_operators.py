"""Operators over many rows against brute force."""

import gzip
import hashlib
import itertools
import os
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from roadbed.llm import components, decontam, line_dedup, simhash, url_filter, warc
from roadbed.session import stage_root

from .conftest import AWKWARD


def brute_roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    found = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in found} == brute_roots(nodes, links) and len(found) == len(nodes)
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark, awkward, no_docs, sf_dir):
    for docs in (awkward, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
        fps = sorted({fp for _, fp in rows})
        links = [(a, b) for a, b in itertools.combinations(fps, 2) if (a ^ b).bit_count() <= 2]
        roots, names = brute_roots(fps, links), {}
        for doc_id, fp in rows:
            if doc_id is not None:
                names[roots[fp]] = min(doc_id, names.get(roots[fp], doc_id))
        want = sorted((str(i), f"{fp:016x}", str(names.get(roots[fp]))) for i, fp in rows)
        got = simhash.near_duplicates(docs).collect()
        assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
        assert simhash.drop_near_duplicates(docs).columns == docs.columns
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_links_join_dense_groups(spark):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    near = {centre ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(0, 64, 2), 2)}
    chain = [draw.getrandbits(64)]
    for _ in range(60):
        chain.append(chain[-1] ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)))
    values = sorted(near | {centre} | set(chain) | {draw.getrandbits(64) for _ in range(100)})
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    got = simhash.fingerprint_links(spark.createDataFrame(signed, "fp bigint")).collect()
    unsigned = [(r.a & 2**64 - 1, r.b & 2**64 - 1) for r in got]
    assert all((a ^ b).bit_count() <= 42 for a, b in unsigned)
    true = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert brute_roots(values, unsigned) == brute_roots(values, true)
    assert len(got) < 15 * len(values)


def full_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j - 1] + (x != y), last[j] + 1, row[-1] + 1))
    return row[-1]


@settings(max_examples=600, deadline=None)
@given(st.text("abc", max_size=14), st.text("abc", max_size=14), st.integers(0, 4))
def test_edit_distance(a, b, most):
    true = full_distance(a, b)
    assert line_dedup.edit_distance(a, b, most) == (true if true <= most else None)


def edited(line, draw, n):
    for _ in range(n):
        at = draw.randrange(len(line))
        line = draw.choice([line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "z" + line[at + 1 :]])
    return line


@pytest.fixture(scope="session")
def lined(spark):
    draw = random.Random(7)
    letters = "abcdefghij é"
    lines = ["".join(draw.choice(letters) for _ in range(draw.randrange(30, 70))) for _ in range(60)]
    lines += [edited(draw.choice(lines), draw, draw.randrange(1, 4)) for _ in range(200)]
    docs = [(i, "\n".join(draw.choice(lines) for _ in range(draw.randrange(0, 6)))) for i in range(140)]
    docs += [(300, docs[3][1]), (301, None), (None, lines[0]), (302, lines[0] + "\nshort")]
    return spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id bigint, text string, n_chars int, line string")


def test_line_classes(lined, no_docs):
    places = []
    for r in lined.collect():
        for n, line in enumerate((r.text or "").split("\n")):
            line = line.strip(" \t\r")
            if len(line) >= line_dedup.MIN_CHARS:
                places.append((r.doc_id, n, line))
    distinct = sorted({p[2] for p in places})
    links = [(a, b) for a, b in itertools.combinations(distinct, 2) if full_distance(a, b) <= line_dedup.EDITS]
    assert len(links) > 20
    roots, degree, head = brute_roots(distinct, links), {}, {}
    for a, b in links:
        degree[a], degree[b] = degree.get(a, 0) + 1, degree.get(b, 0) + 1
    order = lambda p: (p[0] is not None, p[0] or 0, p[1])
    for p in sorted(places, key=order):
        head.setdefault(roots[p[2]], p[:2])
    want = sorted(map(str, [(*p[:2], *head[roots[p[2]]], degree.get(p[2], 0), head[roots[p[2]]] == p[:2]) for p in places]))
    got = line_dedup.line_classes(lined).collect()
    assert sorted(str(tuple(r)[:6]) for r in got) == want
    assert line_dedup.line_classes(no_docs).count() == 0


def test_repeated_lines_go(lined):
    keep = {(r.doc_id, r.line_no) for r in line_dedup.line_classes(lined).collect() if not r.keep}
    want = {}
    for r in lined.collect():
        text = r.text
        if text and r.doc_id is not None:
            text = "\n".join(x for n, x in enumerate(text.split("\n")) if (r.doc_id, n) not in keep)
        size = lambda t: len((t or "").replace("\n", ""))
        if text == r.text or size(text) > (1 - line_dedup.REDUNDANT) * size(r.text):
            want[r.doc_id] = text
    got = line_dedup.drop_repeated_lines(lined)
    assert got.columns == lined.columns
    assert {r.doc_id: r.text for r in got.collect()} == want
    before = {r.doc_id: r.text for r in lined.collect()}
    assert all(r.n_chars == len(r.text) for r in got.collect() if r.text != before[r.doc_id])


def test_decontamination(spark, awkward, no_docs, sf_dir):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    passages = decontam.passages([(r.item_id, r.text) for r in bench.collect()])
    true = set()
    for r in docs.collect():
        words = decontam.words_of(r.text)
        for item, passage in passages:
            place = decontam._places(passage)
            for at in range(0, max(1, len(words) - 64), 32):
                if decontam.is_leak(passage, place, words[max(0, at - 32) : at + 96])[0]:
                    true.add((r.doc_id, item))
    assert len(true) >= 10 and len(found & true) >= 0.9 * len(true)
    assert found <= true
    bad = {d for d, _ in found}
    left = decontam.drop_contaminated(docs, bench)
    assert {r.doc_id for r in left.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} - bad
    odd = bench.limit(2).union(spark.createDataFrame([(None, "a b"), (7, None), (8, "")], bench.schema))
    assert decontam.contaminated(awkward, odd).count() == 0
    assert decontam.contaminated(no_docs, bench).count() == 0
    assert decontam.contaminated(awkward, bench.limit(0)).count() == 0
    assert decontam.drop_contaminated(awkward, bench.limit(0)).count() == len(AWKWARD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=12), st.lists(st.sampled_from("abcd"), max_size=20))
def test_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert decontam.longest_common(decontam._places(a), len(a), b) == table[-1][-1]


LONG = "<p>" + "payload " * 40 + "</p>"
PAGES = [
    (5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, "http://a/3", "short"), (2, "http://a/4", "short"),
    (3, "http://a/2", LONG), (None, None, LONG), (7, "http://é/\r\nX: y", None), (8, "", "é" * 200),
    (None, "u", "only " * 50), (None, "v", "only " * 50), (11, "http://a/6", "a\r\n\r\nWARC/1.1\r\n" * 3000),
]


def archive(spark, pages, **limits):
    folder = warc.new_archive(spark)
    manifest = warc.write_warc(pages, folder, **limits)
    return folder, manifest


def test_warc(spark):
    pages = spark.createDataFrame([(*p, "t") for p in PAGES], "page_id bigint, url string, html string, shard string")
    folder, manifest = archive(spark, pages, roll_bytes=300, rows_per_shard=4)
    rows = warc.read_warc(spark, folder).collect()
    assert len(rows) == len(PAGES) and all(r.intact for r in rows)
    firsts = {}
    for page_id, _, html in PAGES:
        if page_id is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page_id, firsts.get(html, page_id))
    want = []
    for page_id, url, html in PAGES:
        payload, first = (html or "").encode(), firsts.get(html)
        revisit = first is not None and page_id != first
        digest = hashlib.sha256(payload).hexdigest()
        kind = ("revisit", first, None) if revisit else ("response", None, payload)
        want.append(str((page_id, len(payload), digest, *kind)))
    got = [str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                None if r.payload is None else bytes(r.payload))) for r in rows]
    assert sorted(got) == sorted(want)
    assert {r.url for r in rows} >= {None, "", "http://a/1"}
    entries = manifest.collect()
    data = folder.removeprefix("file://") + "/data"
    assert {e.name for e in entries} == set(os.listdir(data)) and len(entries) > 3
    for e in entries:
        blob = open(f"{data}/{e.name}", "rb").read()
        assert (len(blob), hashlib.sha256(blob).hexdigest()) == (e.bytes, e.sha256)
        assert gzip.decompress(blob).count(b"WARC/1.1\r\nWARC-Type") == e.records
    again = archive(spark, pages.repartition(5), roll_bytes=300, rows_per_shard=4)[1]
    key = lambda m: sorted((e.name, e.sha256) for e in m.collect())
    assert key(again) == key(manifest)
    empty, _ = archive(spark, pages.limit(0))
    assert warc.read_warc(spark, empty).count() == 0
    assert stage_root(spark) in folder


URLS = [
    (1, "http://a.example.org/es/1", "allowed words in text"), (2, "https://EXAMPLE.org/es/", None),
    (3, "http://example.org/en/12?x=/es/", ""), (4, "http://x.example.org", "words"), (5, "http://b.com/fr/a", "x"),
    (6, "http://b.com/de/casino", "casino casino bonus"), (7, None, None), (8, "no scheme", "text"),
    (9, "http://notexample.net/en/casinobonus#f", "bonus"), (10, "http://example.org?q", ""), (None, "://", ""),
    (11, "http://com/fr/?a", ""), (12, "http://xcom/fr/", ""), (1, "http://a.example.org/es/1", "allowed"),
]


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_filter.RULES if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return host, path, best and best[1] + best[2], best and best[0]


def test_urls(spark, sf_dir):
    own = spark.createDataFrame([(*u, 1) for u in URLS], "page_id bigint, url string, html string, odds int")
    for pages in (own, spark.read.parquet(f"{sf_dir}/pages.parquet")):
        want = sorted(map(str, [(r.page_id, *brute_rule(r.url)[:3]) for r in pages.collect()]))
        rows = url_filter.judge_urls(pages).collect()
        assert sorted(str((r.page_id, r.host, r.path, r.rule)) for r in rows) == want
        ruled = {(r.host, r.path): r.verdict for r in rows if r.rule}
        assert all(ruled[h, p] == v for h, p, n, v in map(brute_rule, [r.url for r in pages.collect()]) if n)
        assert {r.verdict for r in rows} <= {"allow", "block"}
    sides = [(i, f"http://casinobonus{i}.com/de/x", "free casino bonus library") for i in range(40)]
    sides += [(i, f"http://library{i}.com/fr/x", "library free") for i in range(40, 80)]
    sides += [(90, "http://freecasino.net/", ""), (91, "http://freelibrary.net/", "")]
    judged = url_filter.judge_urls(spark.createDataFrame(sides, "page_id bigint, url string, html string")).collect()
    learned = {r.page_id: (r.verdict, r.host_words) for r in judged}
    assert learned[90] == ("block", "free casino net") and learned[91] == ("allow", "free library net")
    assert url_filter.judge_urls(own.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(own.filter("page_id in (7, 8)")).collect()} == {"allow"}


def test_segmentation_is_optimal():
    counts = {"free": 9, "casino": 5, "bonus": 4, "bon": 2, "us": 7, "a": 1}
    segmenter = url_filter.Segmenter(counts)
    name = "freecasinobonusa"
    assert segmenter.split(name) == ("free", "casino", "bonus", "a")
    cost = lambda words: sum(map(segmenter._cost, words))
    every = []
    for cuts in itertools.product([0, 1], repeat=9):
        words, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                words.append("casinobonu"[start:i])
                start = i
        every.append([*words, "casinobonu"[start:]])
    assert cost(segmenter.split("casinobonu")) == pytest.approx(min(map(cost, every)))


def test_pipeline(spark, awkward, no_docs, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        for table in (docs, awkward, no_docs):
            out = function(spark, table, sf_dir)
            assert name == "bpe" or out.columns == table.columns
            assert out.count() <= table.count()
    ids = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert 0 < len(ids) < docs.count()
    assert docs.filter(F.col("doc_id").isin(list(ids))).count() == len(ids)
