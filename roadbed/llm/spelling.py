"""Spelling variants: words one edit apart, found by pivotal bigrams.

The bigrams of a word stand in one order for all words, rarer ones first. A
word's prefix is its first three bigrams in that order; by dynamic programming two
of them that share no letter and are rarest in sum become its pivots. One edit
spoils at most one of two disjoint bigrams, so of two words one edit apart the
one whose prefix ends earlier has a pivot in the other's prefix, at the
same place or, behind an inserted or deleted letter, one further. Pivots meet
prefixes by (bigram, length, place) and are verified there; only near pairs leave.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import INDEX, PROBE, in_cells, runs, slices, staged

#: letters and occurrences of a word that takes part
MIN_CHARS, MIN_COUNT = 6, 5
#: a form is this many times as frequent as its variant
TIMES = 5
#: edits between near words; bigrams in a prefix are one more than letters spoiled by them
EDITS = 1
PREFIX = 2 * EDITS + 1
#: index rows under one key that are compared in one task; larger groups are dealt out in blocks
MAX_GROUP = 20_000
#: pairs compared in one go: 1,024 x 1,024
_BLOCK = 1024

# The letters of a run, and one run in so many loses a letter.
RUN = "[^A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP_EVERY = 199

_KEYED = "key int, word string, n bigint, kind tinyint"


def words_of(docs: DataFrame, slip_every: int = SLIP_EVERY) -> DataFrame:
    """(word) for every run of letters of every text, one letter lost now and then.

    Which run loses which letter follows from a checksum of id and run; runs of
    rows without an id lose none.
    """
    text = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    found = docs.select(F.col("doc_id"), F.explode(F.split(text, RUN, -1)).alias("run"))
    found = found.filter(F.char_length("run") >= MIN_CHARS)
    slip = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run")))
    found = found.select("run", F.coalesce(slip, F.lit(1)).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run"))
    )
    word = F.when(F.col("h") % slip_every == 0, shorter).otherwise(F.col("run"))
    return found.select(word.alias("word"))


def vocabulary(docs: DataFrame, slip_every: int = SLIP_EVERY) -> DataFrame:
    """(word, n): different words of enough letters and occurrences."""
    counted = words_of(docs, slip_every).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.char_length("word") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT))


def bigram_ranks(words: DataFrame) -> dict[str, int]:
    """Rank of each bigram, rarest first.

    The letters allow some 8,000 bigrams at most, whatever the number of words.
    """
    pairs = F.transform(
        F.sequence(F.lit(1), F.char_length("word") - 1), lambda at: F.substring(F.col("word"), at, F.lit(2))
    )
    counted = words.select(F.explode(pairs).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {gram: i for i, (gram, _) in enumerate(sorted(counted.collect(), key=lambda r: (r[1], r[0])))}


def prefix_and_pivots(word: str, ranks: dict[str, int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(rank, place) of the prefix of a word and of its pivots.

    The prefix is cut behind its third bigram; others of the same rank belong to it,
    so that equal bigrams are in or out together.
    """
    grams = sorted((ranks[word[i : i + 2]], i) for i in range(len(word) - 1))
    last = grams[PREFIX - 1][0]
    prefix = [g for g in grams if g[0] <= last]
    return prefix, _pivots(sorted(grams[:PREFIX], key=lambda g: g[1]))


def _pivots(grams: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``EDITS`` + 1 disjoint bigrams, in order of place, with the smallest sum of ranks.

    ``best[k]`` after a bigram is the cheapest choice of k bigrams up to it;
    it goes on from the last bigram that ends before this one begins.
    """
    best = [[(0, [])] + [(math.inf, [])] * (EDITS + 1)]
    for i, (rank, at) in enumerate(grams):
        before = max((j + 1 for j in range(i) if grams[j][1] + 2 <= at), default=0)
        row = [best[-1][0]]
        for k in range(1, EDITS + 2):
            cost, chosen = best[before][k - 1]
            row.append(min(best[-1][k], (cost + rank, [*chosen, (rank, at)])))
        best.append(row)
    return best[-1][EDITS + 1][1]


def _key(rank: int, length: int, at: int) -> int:
    """Keys of different (bigram, length, place) may be equal: both are verified."""
    return hash((rank, length, at)) & 0x7FFFFFFF


def _keys(shared):
    """Index rows of prefixes and probe rows of pivots, for every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in slices(batches, 4096):
            keys, at, kinds = [], [], []
            for i, word in enumerate(batch["word"].to_pylist()):
                size = len(word)
                prefix, pivots = prefix_and_pivots(word, ranks)
                found = {_key(rank, size, p): INDEX for rank, p in prefix}
                for rank, p in pivots:  # equal length, one more, one less
                    for more, moved in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1)):
                        key = _key(rank, size + more, p + moved)
                        found[key] = found.get(key, 0) | PROBE
                keys += found
                kinds += found.values()
                at += [i] * len(found)
            rows = pa.array(at, pa.int64())
            columns = [pa.array(keys, pa.int32()), batch["word"].take(rows), batch["n"].take(rows), pa.array(kinds, pa.int8())]
            yield pa.record_batch(columns, ["key", "word", "n", "kind"])

    return run


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters (one byte each) in rows padded with zeros, lengths, and masks.

    A mask has the parity of the counts of letters in 64 classes: one edit changes two bits at most.
    """
    size = np.array([len(w) for w in words])
    text = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    letters = np.zeros((len(words), size.max()), np.uint8)
    letters[np.arange(size.max()) < size[:, None]] = text
    bits = np.uint64(1) << (text & 63).astype(np.uint64)
    return letters, size, np.bitwise_xor.reduceat(bits, np.append(0, np.cumsum(size)[:-1]))


def one_edit(letters: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words ``a`` and ``b`` differ by one letter put in, left out or replaced."""
    swap = size[a] > size[b]
    short, long = np.where(swap, b, a), np.where(swap, a, b)
    x, y = letters[short], letters[long]
    width = letters.shape[1]
    inside = np.arange(width) < size[short][:, None]
    differ = ((x != y) & inside).sum(axis=1)
    same_start = np.where(((x != y) & inside).any(axis=1), ((x != y) & inside).argmax(axis=1), size[short])
    shifted = np.zeros_like(y)
    shifted[:, :-1] = y[:, 1:]
    # behind the first difference the longer word goes on one letter later
    behind = np.arange(width) >= same_start[:, None]
    moved = ((x != shifted) & inside & behind).sum(axis=1)
    gap = size[long] - size[short]
    return ((gap == 0) & (differ == 1)) | ((gap == 1) & (moved == 0))


def _near_pairs(words: np.ndarray, n: np.ndarray, role: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near pairs of index and probe rows of each group, at most some million pairs compared at once."""
    letters, size, mask = letters_of(words.tolist())
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    index, probe = np.flatnonzero(role & INDEX), np.flatnonzero(role & PROBE)
    first = np.searchsorted(group[index], np.arange(len(starts)))
    partners = np.diff(first)[group[probe]]
    probe, partners = probe[partners > 0], partners[partners > 0]
    part = np.cumsum(partners) // (_BLOCK * _BLOCK)
    for some in np.split(np.arange(len(probe)), np.flatnonzero(np.diff(part)) + 1):
        count = partners[some]
        p = np.repeat(probe[some], count)
        step = np.arange(len(p)) - np.repeat(np.cumsum(count) - count, count)
        i = index[first[group[p]] + step]
        maybe = np.bitwise_count(mask[p] ^ mask[i]) <= 2 * EDITS
        p, i = p[maybe], i[maybe]
        near = one_edit(letters, size, p, i)
        p, i = p[near], i[near]
        swap = words[p] > words[i]
        a, b = np.where(swap, i, p), np.where(swap, p, i)
        columns = [pa.array(words[a], pa.string()), pa.array(words[b], pa.string()), pa.array(n[a]), pa.array(n[b])]
        yield pa.record_batch(columns, ["a", "b", "n_a", "n_b"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, _, words, n, _, role), starts in runs(batches, 2):
        if len(words):
            yield from _near_pairs(words, n, role, starts)


def near_words(words: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b, n_a, n_b): all pairs of different words one edit apart, a < b; ``words`` is (word, n)."""
    shared = words.sparkSession.sparkContext.broadcast(bigram_ranks(words))
    keyed = staged(words.mapInArrow(_keys(shared), _KEYED), "spelling-keys")
    shared.destroy()
    dealt = in_cells(keyed, "word", max_group).repartition("key", "cell").sortWithinPartitions("key", "cell")
    return dealt.mapInArrow(_meet, "a string, b string, n_a bigint, n_b bigint").distinct()


def _roots(links: DataFrame, most: int) -> DataFrame:
    """(word, root): where following forms ends.

    A form is ``TIMES`` as frequent, so a chain has as many steps as ``most`` can be
    divided; each round doubles the steps taken.
    """
    links = staged(links.select("word", F.col("form").alias("root")), "spelling-roots")
    steps = max(1, math.ceil(math.log(max(most, 2), TIMES)))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        then = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if links.join(then, "root", "left_semi").isEmpty():
            break
        further = links.join(then, "root", "left")
        links = staged(further.select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return links


def spelling_variants(docs: DataFrame, slip_every: int = SLIP_EVERY, max_group: int = MAX_GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    ``form`` is the most frequent word one edit away (ties: smallest in order of code
    points) if it is ``TIMES`` as frequent, else NULL; ``root`` is where following
    forms ends. NULL and empty texts have no words; repeated rows count as often as
    they stand; rows without an id take part unchanged. An empty table gives no rows.
    """
    words = staged(vocabulary(docs, slip_every), "spelling-words")
    pairs = staged(near_words(words, max_group), "spelling-pairs")
    both = pairs.select("a", "b", "n_b").union(pairs.select("b", "a", "n_a")).toDF("word", "near", "near_n")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    found = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    told = words.join(found, "word", "left")
    is_form = -F.col("best.rank") >= TIMES * F.col("n")
    told = told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.rank")).alias("form_n"),
    )
    told = staged(told, "spelling-forms")
    links = _roots(told.filter("form is not null"), words.agg(F.max("n")).first()[0] or 0)
    return told.join(links, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
