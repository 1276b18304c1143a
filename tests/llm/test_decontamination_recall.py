"""Passages of a benchmark in long texts, and of more items than are compared at once."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadbed.llm import decontam


def planted(draw, items, words_each, passage_of, vocabulary):
    """One text for each item, with a passage of it somewhere inside."""
    out = []
    for i, item in enumerate(items):
        text = [draw.choice(vocabulary) for _ in range(words_each)]
        at = draw.randrange(words_each)
        out.append((i, " ".join([*text[:at], *passage_of(item), *text[at:]])))
    return out


@pytest.mark.parametrize("words_each", [300, 12_000])
def test_verbatim_passages_in_texts_of_any_length(spark, words_each):
    draw = random.Random(21)
    vocabulary = [f"w{i}" for i in range(60_000)]
    items = [[draw.choice(vocabulary) for _ in range(draw.choice([9, 16, 40]))] for _ in range(40)]
    rows = planted(draw, items, words_each, list, vocabulary)
    clean = [(1000 + i, " ".join(draw.choice(vocabulary) for _ in range(words_each))) for i in range(20)]
    docs = spark.createDataFrame(rows + clean, "doc_id bigint, text string").repartition(8)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert found == {(i, i) for i in range(40)}
    left = decontam.drop_contaminated(docs, bench)
    assert {r.doc_id for r in left.collect()} == {i for i, _ in clean}


def test_items_in_several_blocks(spark, monkeypatch):
    """Paraphrases and copies of items, most of which are in other blocks."""
    monkeypatch.setattr(decontam, "BLOCK", 70)
    draw = random.Random(22)
    vocabulary = [f"w{i}" for i in range(20_000)]
    items = [[draw.choice(vocabulary) for _ in range(40)] for _ in range(300)]

    def paraphrase(item):
        return [draw.choice(vocabulary) if i % 4 == 3 else w for i, w in enumerate(item)]

    rows = planted(draw, items, 400, paraphrase, vocabulary)
    assert all(not set(decontam.seeds(decontam.codes(t))) & set(decontam.seeds(decontam.codes(' '.join(i)))) for (_, t), i in zip(rows, items))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    true = {(i, i) for i in range(300)}
    assert found <= true and len(found) >= 0.9 * len(true)


def test_odd_columns_and_rows(spark):
    bench = spark.createDataFrame(
        [(1, "alpha beta gamma delta epsilon zeta eta theta iota", "x", 1), (None, "a b c d e f g h i", "x", 1), (2, None, "x", 1)],
        "item_id bigint, text string, digest string, doc_id int",
    )
    text = "well alpha beta gamma delta epsilon zeta eta theta iota then"
    rows = [(1, text, "d"), (None, text, "d"), (2, None, "d"), (3, "", "d"), (None, "clean", "d"), (1, text, "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, digest string")
    found = decontam.contaminated(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 1), ("1", 1), ("None", 1)]
    left = decontam.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(str(r.doc_id) for r in left.collect()) == ["2", "3", "None"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "the_", "ab", "ba", "É", "é", "ß", "x²", "日本", "𝒳", "İ", ".", " ", "\n", "!\x00", "\ud800"]), max_size=40))
def test_hashes_are_those_of_the_words(parts):
    text = "".join(parts)
    words = decontam.words_of(text)
    code = decontam.codes(text).tolist()
    assert len(code) == len(words) and len(set(code)) == len(set(words))
    assert dict(zip(words, code)) == {w: int(decontam.codes(w)[0]) for w in words}


def test_latent_space_knows_all_documents(spark, monkeypatch):
    """Directions hold what those of an exact decomposition of all passages hold."""
    monkeypatch.setattr(decontam, "RANK", 20)
    draw = random.Random(23)
    vocabulary = [f"w{i}" for i in range(20_000)]
    topics = [[f"topic{t}x{i}" for i in range(12)] for t in range(20)]
    docs = [" ".join([*topics[i % 20], *draw.choices(vocabulary, k=8)]) for i in range(600)]
    items = [" ".join(draw.choices(vocabulary, k=20)) for _ in range(400)]
    rows = spark.createDataFrame([*enumerate(docs)], "doc_id bigint, text string").repartition(5)
    bench = spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")
    weights = decontam._weights(rows, bench)

    def counts(found):
        return np.array([np.bincount(decontam.buckets(t), minlength=decontam.BUCKETS) for t in found])

    met = (counts(docs) > 0).sum(axis=0)
    idf = np.log((len(docs) + decontam.EXTRA_PASSAGES) / (met + 1))
    idf[idf < decontam.STOP_IDF] = 0
    units = [decontam._unit(counts(found) * idf) for found in (items, docs)]
    whole = np.concatenate([units[0], units[1] * (len(items) / len(docs)) ** 0.5])
    space = weights / np.where(idf > 0, idf, 1)[:, None]
    exact = np.linalg.svd(whole, compute_uv=False)[:20]
    assert ((whole @ space) ** 2).sum() >= 0.95 * (exact**2).sum()


def test_only_candidates_that_share_words_are_compared(monkeypatch):
    """Near vectors alone are no reason to compare words; no leak is lost."""
    rng = np.random.default_rng(3)
    word = [f"w{i}" for i in range(900)]
    draw = lambda low, high, n: " ".join(word[i] for i in rng.integers(low, high, n))
    items = [(i, draw(0, 300, int(n))) for i, n in enumerate(rng.integers(8, 150, 12))]
    # all vectors are alike, so every window is near every passage
    block = decontam._block(decontam.passages(items), np.ones((decontam.BUCKETS, 4), np.float32))
    weights = np.ones((decontam.BUCKETS, 4), np.float32)
    strange = [draw(300, 900, n) for n in (5, 60, 700)]
    mixed = [" ".join([draw(300, 900, 90), text, draw(0, 900, n)]) for (_, text), n in zip(items, range(0, 240, 20))]
    compared = []
    is_leak = decontam.is_leak
    monkeypatch.setattr(decontam, "is_leak", lambda *a: compared.append(1) or is_leak(*a))
    monkeypatch.setattr(decontam, "SHARED", 7)
    assert decontam.leaks_of(strange, block, weights) == [[], [], []] and not compared
    found = decontam.leaks_of(strange + mixed, block, weights)
    monkeypatch.setattr(decontam, "_may_leak", lambda ids, steps, text, window, *_: np.ones(len(window), bool))
    assert found == decontam.leaks_of(strange + mixed, block, weights)
    assert all(i in [leak[0] for leak in own] for i, own in enumerate(found[3:]))


def words_at(draw, low, high, n):
    return " ".join(f"w{draw.randrange(low, high)}" for _ in range(n))


def test_shared_words_are_looked_up_among_those_of_the_benchmark(monkeypatch):
    """What the bound needs grows with the words of the benchmark, and is the count of shared buckets."""
    draw = random.Random(31)
    items = decontam.passages([(i, words_at(draw, 0, 60, draw.randrange(8, 150))) for i in range(9)])
    block = decontam._block(items, np.ones((decontam.BUCKETS, 4), np.float32))
    found = [decontam.codes(words_at(draw, 0, 140, n)) for n in (4, 31, 32, 33, 64, 65, 97, 500, 3000)]
    ids, steps = decontam._strides(found)
    windows = np.maximum(1, steps - 1)
    near = [(t, w, p) for t in range(len(found)) for w in range(windows[t]) for p in range(len(items)) if draw.random() < 0.8]
    text, window, passage = map(np.array, zip(*near))

    def shares(t, w, p):
        around = set(decontam.in_buckets(found[t][max(0, w * 32 - 32) : w * 32 + 96]).tolist())
        own = decontam.in_buckets(np.array(block.codes[p], np.uint64)).tolist()
        return sum(b in around for b in own) >= decontam.COMMON_WITH_ANSWER * len(own)

    true = [shares(*n) for n in near]
    assert 0 < sum(true) < len(true)
    tracemalloc.start()
    may = decontam._may_leak(ids, steps, text, window, passage, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert may.tolist() == true
    assert peak < 2_000_000  # a table of all buckets has 33 kB a window, 4 MB here
    monkeypatch.setattr(decontam, "COSINES", 400)
    monkeypatch.setattr(decontam, "SHARED", 5)
    assert decontam._may_leak(ids, steps, text, window, passage, block).tolist() == true


def test_copied_runs_meet_in_all_windows_around_them():
    draw = random.Random(32)
    items = decontam.passages([(i, words_at(draw, 0, 30, draw.randrange(8, 150))) for i in range(9)])
    block = decontam._block(items, np.ones((decontam.BUCKETS, 4), np.float32))
    found = [words_at(draw, 0, 30, n).split() for n in (4, 5, 40, 97, 700)]
    found += [[*words_at(draw, 50, 90, n).split(), *items[n % len(items)][1][:6], "end"] for n in (0, 27, 59, 91, 300)]
    code = [decontam.codes(" ".join(words)) for words in found]
    windows = np.maximum(1, decontam._strides(code)[1] - 1)

    def runs(words):
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    true = {
        (t, w, p)
        for t, words in enumerate(found)
        for w in range(windows[t])
        for p, (_, passage) in enumerate(items)
        if runs(words[max(0, w * 32 - 32) : w * 32 + 96]) & runs(passage)
    }
    own = decontam._seeded(code, block, windows)
    assert isinstance(own, set) and own == true  # each once, however many runs a passage shares


def test_groups_of_passages_are_cut_and_joined_as_columns():
    values, ends = np.array([7, 8, 9, 65535, 1], np.uint16), np.array([2, 3, 5])
    column = decontam._cut(values, ends)
    assert column.to_pylist() == [values[:2].tobytes(), values[2:3].tobytes(), values[3:].tobytes()]
    for at, n in ((0, 3), (1, 2), (1, 1), (2, 1), (3, 0)):
        for own in (column.slice(at, n), column.slice(at, n).cast(pa.large_binary())):
            joined, size = decontam._joined(own, np.uint16)
            assert joined.tolist() == np.concatenate([[], *np.split(values, ends)[at : at + n]]).tolist()
            assert size.tolist() == [2, 1, 2][at : at + n]
