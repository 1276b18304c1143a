"""Spelling variants against comparing all words with all words."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from roadbed.llm import queries, spelling


def brute_words(docs: list[tuple], every: int = 199) -> Counter:
    n: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return Counter({w: c for w, c in n.items() if len(w) >= 6 and c >= 5})


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(n: Counter) -> list[tuple]:
    partners = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if abs(len(a) - len(b)) <= 1 and near(a, b):
            partners[a].append(b)
            partners[b].append(a)
    form = {}
    for w, others in partners.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(partners[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def tuples(df) -> list[tuple]:
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def crowd(seed: int) -> list[tuple]:
    """Texts of words close to each other, of very different frequency."""
    draw = random.Random(seed)
    words = {"".join(draw.choice("aaabbé") for _ in range(draw.randint(5, 8))) for _ in range(400)}
    rows = []
    for i, word in enumerate(sorted(words)):
        rows.append((i, " ".join([word.upper() if i % 3 else word] * draw.choice([4, 5, 6, 30, 200, 1000]))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_equals_all_pairs(spark):
    rows = crowd(1)
    assert tuples(spelling.spelling_variants(frame(spark, rows))) == brute(brute_words(rows))


def test_large_groups_in_blocks_equal_all_pairs(spark):
    rows = crowd(2)
    expected = brute(brute_words(rows))
    assert tuples(spelling.spelling_variants(frame(spark, rows), max_group=3)) == expected
    assert sum(r[4] for r in expected) > 300


def test_letters_are_lost_as_told(spark):
    rows = [(i, "Spelling ÀÉÿ×÷abc, Variants_of wOrds-here don't") for i in range(400)] + [(None, "spelling variants here")]
    found = {r.word: r.n for r in spelling.vocabulary(frame(spark, rows), slip_every=3).collect()}
    assert found == dict(brute_words(rows, every=3)) and len(found) > 10


def test_chains_are_followed_to_the_last(spark):
    words = ["abcdef", "abcdeg", "abcdhg", "abcihg", "abjihg"]
    rows = [(None, " ".join([w] * 5 * 6**i)) for i, w in enumerate(words)]
    found = {r.word: (r.form, r.root) for r in spelling.spelling_variants(frame(spark, rows)).collect()}
    assert found["abcdef"] == ("abcdeg", "abjihg") and found["abcihg"] == ("abjihg", "abjihg")
    assert found["abjihg"] == (None, "abjihg")


def test_ties_go_by_code_points(spark):
    rows = [(None, "zzzzza " * 50 + "zzzzzé " * 50 + "zzzzzb " * 50 + "zzzzzz " * 10)]
    found = {r.word: r for r in spelling.spelling_variants(frame(spark, rows)).collect()}
    assert found["zzzzzz"].form == "zzzzza" and found["zzzzzz"].n_near == 3


def test_pivots_are_disjoint_and_cheapest():
    draw = random.Random(3)
    for _ in range(300):
        word = "".join(draw.choice("abcd") for _ in range(draw.randint(6, 12)))
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        draw.shuffle(grams)
        ranks = {g: i for i, g in enumerate(grams)}
        prefix, pivots = spelling.prefix_and_pivots(word, ranks)
        first = sorted(prefix)[: spelling.PREFIX]
        cheapest = min(a[0] + b[0] for a, b in combinations(first, 2) if abs(a[1] - b[1]) >= 2)
        assert set(pivots) <= set(prefix) and sum(r for r, _ in pivots) == cheapest
        assert abs(pivots[0][1] - pivots[1][1]) >= 2


def test_one_edit_equals_plain():
    draw = random.Random(4)
    words = ["".join(draw.choice("ab") for _ in range(draw.randint(6, 9))) for _ in range(120)]
    letters, size, mask = spelling.letters_of(words)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(120), np.arange(120)))
    expected = [near(words[i], words[j]) for i, j in zip(a, b)]
    assert spelling.one_edit(letters, size, a, b).tolist() == expected
    assert (np.bitwise_count(mask[a] ^ mask[b])[np.array(expected)] <= 2).all()


def test_awkward_rows(spark, awkward, no_docs):
    long = frame(spark, [(1, "q" * 2_000_000 + " " + "longer " * 300_000)])
    assert {r.word for r in spelling.spelling_variants(long).collect()} == {"longer"}
    assert spelling.spelling_variants(awkward).count() >= 0
    assert spelling.spelling_variants(no_docs).count() == 0
    clash = frame(spark, crowd(1)).select("*", *[F.lit("x").alias(c) for c in ("word", "n", "key", "run", "b", "h")])
    assert spelling.vocabulary(clash).count() > 0


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert tuples(queries.queries()["op11_spelling"](spark, sf_dir)) == brute(brute_words(rows))
