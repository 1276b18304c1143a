"""Collocations against plain counting, in one task and over many borders."""

import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from roadbed.llm import collocations, queries
from tests.compare import differences, open_tables


def brute(docs: list[tuple], top: int, least: int) -> list[tuple]:
    counts: dict[str, Counter] = defaultdict(Counter)
    for lang, text in docs:
        own = counts[lang or "und"]
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            for size in (1, 2, 3):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        n = sum(f for p, f in own.items() if len(p) == 1)
        found = []
        for p, a in own.items():
            if len(p) < 2 or a < least:
                continue
            cuts = [(1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            longer = [own[q] for q in own if len(q) > len(p) and own[q] >= least and (q[:2] == p or q[1:] == p)]
            if not any(100 * f >= 50 * a for f in longer):
                found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


DOCS = [
    ("en", "New York is big. New York, new york; NEW\tYORK city! york new"),
    ("en", "the new york city hall\nthe new york city hall\x0bthe city. a b a b"),
    ("en", None), ("en", ""), (None, "ß é ß é ß é ß\x01é"), ("und", "ß é"), ("a\tb", "x y x y x y"), ("a", "b x y b x y"),
    ("fr", "le le le le le le le le le"), ("fr", "... !?"), ("fr", "z" * 100_000 + " k z k"),
]


@pytest.mark.parametrize("chunk, rows", [(1 << 21, 1 << 16), (5, 2)])
def test_equals_plain_counting(spark, monkeypatch, chunk, rows):
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "ROWS", rows)
    docs = spark.createDataFrame([(*d, 1, "w") for d in DOCS * 2], "lang string, text string, doc_id bigint, w1 string")
    got = collocations.collocations(docs.repartition(3), top=4, least=2).collect()
    assert sorted(map(tuple, got)) == brute(DOCS * 2, 4, 2)


@pytest.mark.parametrize("bits", [(1, 1, 1), (2, 1, 3), (25, 22, 17)])
def test_words_of_equal_hash(spark, monkeypatch, bits):
    """Windows are sorted by one number; words whose hashes meet are counted like others."""
    monkeypatch.setattr(collocations, "CHUNK", 5)
    docs = spark.createDataFrame([(*d, 1) for d in DOCS * 2], "lang string, text string, doc_id bigint")
    got = collocations.phrase_counts(docs.repartition(3), 2, bits)
    told = [(r.lang, tuple(filter(None, (r.w1, r.w2, r.w3))), r.n) for r in got.collect()]
    want = collocations.phrase_counts(docs.coalesce(1), 2).collect()
    assert sorted(told) == sorted((r.lang, tuple(filter(None, (r.w1, r.w2, r.w3))), r.n) for r in want)
    best = collocations.scored_phrases(got).collect()
    listed = [(lang, phrase, a, left, right, score) for lang, _, phrase, a, left, right, _, score in brute(DOCS * 2, 9999, 2)]
    assert sorted(map(tuple, best)) == sorted(listed)
    sort = spark._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple").split("Sort [")[1]
    assert sort.startswith("((shiftleft(") and "head#" not in sort.split("ASC")[1].split("]")[0]


def test_runs_over_batches_and_ends():
    """A stream cut anywhere gives the sums of the whole; small inner runs go."""
    keys = ["a", "a", "b", "c", "c", "c", "d"]
    for cut in range(1, len(keys)):
        batches = []
        for part in (keys[:cut], keys[cut:]):
            words, nothing = pa.array(part), pa.array([""] * len(part))
            batches.append(pa.record_batch([words, nothing, nothing, pa.array([1] * len(part))], ["head", "w2", "w3", "n"]))
        found = [r for b in collocations._sum_runs(3)(iter(batches)) for r in b.to_pylist()]
        assert {(r["head"], r["n"]) for r in found} == {("a", 2), ("c", 3), ("d", 1)}
        assert len(found) == 3


def test_long_text_is_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "PART", 10)
    text = b"One two three. four five,six seven eight nine ten\neleven"
    parts = list(collocations.tokens_of(text))
    assert len(parts) > 2
    joined = b" ".join(t for part in parts for t in part)
    assert [p.split() for p in joined.split(b"\n") if p.split()] == [
        p.split() for p in re.split(rb"[.,\n]", text.lower()) if p.split()
    ]


def test_many_words_are_numbered_without_overflow(spark, monkeypatch):
    """The wide path gives the same windows as the packed one."""
    tokens = [b"a", b"b", b"c", b"\n", b"a", b"b", b"\n", b"a", b"b", b"c", b"\n"]
    packed = [b.to_pylist() for b in collocations._count_windows(b"en", tokens)]
    class Many(int):
        def __pow__(self, other):
            return 2**70

    monkeypatch.setattr(collocations, "len", lambda x: Many(len(x)), raising=False)
    assert [b.to_pylist() for b in collocations._count_windows(b"en", tokens)] == packed


def test_awkward_rows(spark, awkward, no_docs):
    assert collocations.collocations(awkward, least=2).count() > 0
    assert collocations.collocations(no_docs).count() == 0


def test_products_beyond_64_bits(spark):
    a = 40_000_000_000
    rows = [(1, "en", "x", "", "", a), (1, "en", "y", "", "", a + 1), (2, "en", "x", "y", "", a - 1)]
    counts = spark.createDataFrame(rows, "size int, lang string, w1 string, w2 string, w3 string, n bigint")
    (row,) = collocations.scored_phrases(counts).collect()
    assert row.score == 1_000_000 * (a - 1) ** 2 // (a * (a + 1))


def test_query_equals_sql(spark, sf_dir):
    got = queries.queries()["op13_collocations"](spark, sf_dir).toPandas()
    assert len(got) and differences(got, open_tables(sf_dir).execute(queries.oracle_sql()["op13_collocations"]).df()) == ""


def test_parts_are_merge_joined(spark, sf_dir):
    counts = collocations.phrase_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    words, _ = collocations._lookup(counts, {"w1": "w1"}, l="n")
    plan = counts.join(words, ["lang", "w1"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
