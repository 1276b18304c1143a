"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed words, with frequencies over the passages
of all documents. A randomised SVD, worked out by sums over tasks from all passages
of the benchmark and of the documents, gives the latent space. Every window
of every document is compared with every benchmark passage by cosine in that
space; windows that share a run of words with a passage are candidates as well,
so what is copied word by word is found however little weight its words have.
Candidates are checked on their words: the longest common subsequence must cover
enough of the passage, or a little less if the passage's answer, its last words,
stands there as well.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import slices, staged, texts

BUCKETS = 1 << 15
RANK = 64
#: more directions than kept, and times all passages are read for them
OVERSAMPLE, PASSES = 8, 3
#: words of a window (two strides), and from one window to the next
WINDOW, STRIDE = 64, 32
#: words, and cosines, of texts that are worked out together, and letters a word has about
TOGETHER, COSINES, LETTERS = 4096, 4_000_000, 6
#: candidates whose words are compared together
SHARED = 1 << 14
#: places for each seed of a block in the table that tells most other seeds apart, and the most places
SEED_ROOM, MAX_SEED_TABLE = 64, 1 << 22
#: passages whose buckets are looked up together
GROUP = 8
#: rows of the space that are summed together, passages a task sums at least, and the most such tasks
SUM_ROWS, FIT_ROWS, FIT_TASKS = 1024, 131_072, 256
#: benchmark passages compared in one go; documents are read once for each such block
BLOCK = 16_384
CANDIDATE_COSINE = 0.5
#: words in common, one after the other, that make a candidate whatever the cosine
SEED_WORDS = 5
#: buckets of smaller inverse frequency are stop words and weigh nothing;
#: passages without words that are added to the count, so that few passages
#: do not make every word a stop word
STOP_IDF, EXTRA_PASSAGES = 3.0, 1000
#: share of a passage's words in common order that proves it, and with its answer
COMMON, COMMON_WITH_ANSWER = 0.6, 0.45
ANSWER_WORDS = 8
#: digests of leaking texts are broadcast up to this many (some 20 MB), else joined
MAX_BROADCAST_TEXTS = 200_000
#: shorter benchmark passages prove nothing
MIN_WORDS = 8

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS = np.array([], np.uint64), np.array([], np.uint64)
Leak = tuple[int, float, float, bool]
_WORDS = re.compile(r"\w+").findall


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


@lru_cache(maxsize=1)
def _word_letters() -> np.ndarray:
    """Whether a code point is part of a word, as ``\\w`` has it."""
    n = sys.maxunicode + 1
    letters = np.fromiter(map(str.isalnum, map(chr, range(n))), bool, n)
    letters[ord("_")] = True
    return letters


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``_ODD`` modulo 2**64, and of its inverse."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        _POWERS = tuple(np.cumprod(np.append(np.uint64(1), np.full(size, x, np.uint64))) for x in (_ODD, inverse))
    return _POWERS


def codes_together(found: list[str]) -> list[np.ndarray]:
    """``codes`` of each text, worked out in one go."""
    lowered = [text.lower() for text in found]
    start, own = _hashes("\n".join(lowered))
    first = np.cumsum([len(text) + 1 for text in lowered[:-1]])
    return np.split(own, np.searchsorted(start, first))


def codes(text: str) -> np.ndarray:
    """A hash of each word of a text, in order: those of ``words_of``, without making them."""
    return _hashes(text.lower())[1]


def _hashes(lowered: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of a text in lower case starts, and its hash.

    The hash of a word is a polynomial in its letters, the difference of two sums
    over the letters before its end and its start.
    """
    letters = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(letters) + 2, bool)
    inside[1:-1] = _word_letters()[letters]
    border = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = border[::2], border[1::2]
    power, inverse = _powers(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(letters * power[: len(letters)], out=sums[1:])
    own = (sums[end] - sums[start]) * inverse[start]
    # the last bits of such a sum know the last bits of the letters only
    own = (own ^ own >> np.uint64(32)) * _MIX
    return start, own ^ own >> np.uint64(29)


def together(found: list[str]) -> Iterator[list[str]]:
    """Texts in lists of some ``TOGETHER`` words; a long text ends its list."""
    held, n = [], 0
    for text in found:
        held.append(text)
        n += len(text)
        if n >= TOGETHER * LETTERS:
            yield held
            held, n = [], 0
    if held:
        yield held


def in_buckets(code: np.ndarray) -> np.ndarray:
    return (code & np.uint64(BUCKETS - 1)).astype(np.int64)


def buckets(text: str) -> np.ndarray:
    return in_buckets(codes(text))


def seeds(code: np.ndarray) -> np.ndarray:
    """A hash of every run of ``SEED_WORDS`` words; equal runs have equal hashes."""
    if len(code) < SEED_WORDS:
        return np.array([], np.uint64)
    mixed = np.zeros(len(code) - SEED_WORDS + 1, np.uint64)
    for i in range(SEED_WORDS):
        mixed = (mixed ^ code[i : len(code) - SEED_WORDS + 1 + i]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return mixed


#: columns of a group of passages, and what they hold
_GROUPED = {"own": np.uint16, "passage": np.uint8, "tf": np.uint8}


def passage_buckets(rows: DataFrame, name: str) -> DataFrame:
    """(own, passage, tf) of every ``GROUP`` passages that follow each other, written once.

    Passages meet their buckets: ``own`` is the bucket, in order, ``passage`` the number
    of the passage in the group and ``tf`` how often the bucket is met there.
    """

    def grouped(ids: list[np.ndarray]) -> list[pa.Array]:
        words = np.array([len(i) for i in ids])
        n = -(-words // WINDOW)
        first = np.repeat(np.cumsum(n) - n, words)
        within = np.arange(words.sum()) - np.repeat(np.cumsum(words) - words, words)
        passage = first + within // WINDOW
        keys = (passage // GROUP * BUCKETS + np.concatenate(ids)) * GROUP + passage % GROUP
        keys.sort()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        tf = np.diff(starts, append=len(keys)).astype(np.uint8)
        keys = keys[starts]
        own = (keys // GROUP & (BUCKETS - 1)).astype(np.uint16)
        numbers = (keys % GROUP).astype(np.uint8)
        ends = np.cumsum(np.bincount(keys // (GROUP * BUCKETS)))
        return [_cut(values, ends) for values in (own, numbers, tf)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for held in together(batch["text"].to_pylist()):
                if ids := [in_buckets(code) for code in codes_together(held) if len(code)]:
                    found.append(grouped(ids))
            if found:
                yield pa.record_batch([*map(pa.concat_arrays, zip(*found))], ["own", "passage", "tf"])

    return staged(rows.select("text").mapInArrow(count, "own binary, passage binary, tf binary"), name)


def _cut(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``values`` as a binary column, a row up to each end."""
    offsets = np.append(0, ends * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _joined(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows of a binary column, one after the other, and how many each row has."""
    if not len(column):
        return np.array([], kind), np.array([], np.int64)
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = np.dtype(kind).itemsize
    values = np.frombuffer(data, kind, (offsets[-1] - offsets[0]) // size, offsets[0])
    return values, np.diff(offsets) // size


def passage_frequencies(passages: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse frequency of every bucket over all passages, and their number.

    A passage has as many words in a long text as in a short one, so long texts
    do not touch every bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches):
            df += np.bincount(_joined(batch["own"], np.uint16)[0], minlength=BUCKETS)
            numbers, size = _joined(batch["passage"], np.uint8)
            if len(numbers):
                n += int((np.maximum.reduceat(numbers, np.cumsum(size) - size).astype(np.int64) + 1).sum())
        found = np.flatnonzero(df)
        columns = [pa.array(np.append(found, BUCKETS)), pa.array(np.append(df[found], n))]
        yield pa.record_batch(columns, ["bucket", "n"])

    counted = passages.select("own", "passage").mapInArrow(count, "bucket bigint, n bigint")
    df = np.zeros(BUCKETS + 1)  # as many rows as buckets
    for bucket, n in counted.groupBy("bucket").sum("n").collect():
        df[bucket] = n
    idf = np.log((df[BUCKETS] + EXTRA_PASSAGES) / (df[:BUCKETS] + 1)).astype(np.float32)
    return np.where(idf < STOP_IDF, np.float32(0), idf), int(df[BUCKETS])


def _vectors(batch: pa.RecordBatch, idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, buckets x passages) of groups of passages of unit length; what weighs nothing is left out."""
    (own, size), (number, _), (tf, _) = (_joined(batch[c], k) for c, k in _GROUPED.items())
    own, group = own.astype(np.int64), np.repeat(np.arange(batch.num_rows), size)
    weight = tf * idf[own]
    kept = np.flatnonzero(weight)
    own, group, weight = own[kept], group[kept], weight[kept]
    passage = group * GROUP + number[kept]
    weight /= np.sqrt(np.bincount(passage, weight * weight)).astype(np.float32)[passage]
    # the place of each bucket among those of its group
    new = np.append(True, (own[1:] != own[:-1]) | (group[1:] != group[:-1]))[: len(own)]
    starts = np.flatnonzero(new)
    live, n_live = own[starts], np.bincount(group[starts], minlength=batch.num_rows)
    firsts = np.cumsum(n_live) - n_live
    place = (np.cumsum(new) - 1 - firsts[group]) * GROUP + passage % GROUP
    ends = np.cumsum(np.bincount(group, minlength=batch.num_rows)).tolist()
    for at, end, first, n in zip([0, *ends], ends, firsts.tolist(), n_live.tolist()):
        if n:
            dense = np.zeros(n * GROUP, np.float32)
            dense[place[at:end]] = weight[at:end]
            yield live[first : first + n], dense.reshape(n, GROUP)


def _image(passages: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What all passages make of the directions ``q``.

    Tasks send the rows they touch, in parts of ``SUM_ROWS`` rows that are summed in
    parallel; the sum has the fixed size of ``q``.
    """
    context = passages.sparkSession.sparkContext
    shared, width = context.broadcast((idf, q)), q.shape[1]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, q = shared.value
        total, touched = np.zeros_like(q), np.zeros(len(q), bool)
        for batch in slices(batches):
            for own, weight in _vectors(batch, idf):
                # buckets are in range; without checks rows are copied faster
                found = total.take(own, axis=0, mode="clip")
                found += weight @ (weight.T @ q.take(own, axis=0, mode="clip"))
                total[own] = found
                touched[own] = True
        for at in range(0, len(q), SUM_ROWS):
            rows = np.flatnonzero(touched[at : at + SUM_ROWS])
            if len(rows):
                parts = [[at], [rows.astype(np.int32).tobytes()], [total[at + rows].tobytes()]]
                yield pa.record_batch([pa.array(p) for p in parts], ["at", "rows", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, rows, part in zip(*(c.to_pylist() for c in batch.columns)):
                own = total.setdefault(at, np.zeros((SUM_ROWS, width), np.float32))
                own[np.frombuffer(rows, np.int32)] += np.frombuffer(part, np.float32).reshape(-1, width)
        for at, part in total.items():
            yield pa.record_batch([pa.array([at]), pa.array([part.tobytes()])], ["at", "part"])

    parts = passages.mapInArrow(apply, "at bigint, rows binary, part binary").repartition("at")
    image = np.zeros_like(q)
    for at, part in parts.mapInArrow(add, "at bigint, part binary").collect():  # as large as q
        image[at : at + SUM_ROWS] = np.frombuffer(part, np.float32).reshape(-1, width)
    shared.destroy()
    return image


def latent_space(passages: DataFrame, n: int, benchmark: DataFrame, idf: np.ndarray) -> np.ndarray:
    """(BUCKETS, RANK): right singular vectors of all passages, ``n`` of documents and the benchmark's.

    The documents count no more than the benchmark in sum, however many they
    are; else the directions would tell documents apart, and not what is looked for.
    """

    def bounded(df: DataFrame, rows: int) -> DataFrame:
        return df.coalesce(max(1, min(FIT_TASKS, rows // FIT_ROWS)))

    items = passage_buckets(texts(benchmark, "item_id"), "lsa-items")
    n_items = passage_frequencies(items)[1]
    items, passages = bounded(items, n_items), bounded(passages, n)
    share = np.float32(min(1.0, n_items / max(1, n)))
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((BUCKETS, RANK + OVERSAMPLE), np.float32))[0]
    for _ in range(PASSES):
        image = _image(items, idf, q) + share * _image(passages, idf, q)
        small, before = q.T @ image, q
        q = np.linalg.qr(image)[0]
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return before @ turn[:, np.argsort(-values)[:RANK]]


@dataclass
class Block:
    """Benchmark passages that are compared together."""

    item: np.ndarray
    words: list[list[str]]
    places: list[dict[str, int]]  # places of each word in its passage, as bits
    codes: list[list[int]]
    code_places: list[dict[int, int]]  # the same of hashes
    columns: np.ndarray  # the column of each bucket that a passage has, 0 for others and for no word
    n_columns: int
    own_columns: np.ndarray  # (passages, WINDOW), 0 behind the last word
    least: np.ndarray  # words a text must share with the passage
    vectors: np.ndarray  # (RANK, passages), unit length
    seeds: np.ndarray  # sorted hashes of runs of words
    owner: np.ndarray  # the passage of each
    maybe: np.ndarray  # whether any seed has these last bits; as long as a power of two


def passages(items: list[tuple[int, str]]) -> list[tuple[int, list[str]]]:
    """Passages of ``WINDOW`` words at most; long items have several."""
    out = []
    for item, text in items:
        words = words_of(text)
        if len(words) >= MIN_WORDS:
            for at in range(0, max(1, len(words) - MIN_WORDS + 1), WINDOW):
                out.append((item, words[at : at + WINDOW]))
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _sums_of_strides(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row of buckets; ``BUCKETS`` stands for no word."""
    sums = np.empty((len(ids), 1, weights.shape[1]), np.float32)
    ones = np.ones((1, ids.shape[1]), np.float32)  # a product adds up faster than a sum
    for at in range(0, len(ids), STRIDE):
        part = ids[at : at + STRIDE]
        found = weights.take(part, axis=0, mode="clip")
        found[part == BUCKETS] = 0
        np.matmul(ones, found, out=sums[at : at + STRIDE])
    return sums[:, 0]


def _strides(codes_of: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the strides of texts, a row each, and the number of strides of each text."""
    size = np.array([len(c) for c in codes_of])
    steps = -(-size // STRIDE)
    first = np.cumsum(steps) - steps
    ids = np.concatenate(codes_of)
    # where each word stands once every text ends with a whole stride
    at = np.arange(len(ids)) + np.repeat(first * STRIDE - (np.cumsum(size) - size), size)
    padded = np.full(steps.sum() * STRIDE, BUCKETS)
    padded[at] = in_buckets(ids)
    return padded.reshape(-1, STRIDE), steps


def _vectors_of_strides(ids: np.ndarray, steps: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = _sums_of_strides(ids, weights)
    within = np.arange(len(ids)) - np.repeat(np.cumsum(steps) - steps, steps)
    is_last = within == np.repeat(steps, steps) - 1
    windows = sums.copy()
    windows[:-1] += np.where(is_last[:-1, None], np.float32(0), sums[1:])
    return _unit(windows[~is_last | (within == 0)]), np.maximum(1, steps - 1)


def window_vectors(codes_of: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Latent vectors of the windows of texts, and the number of windows of each.

    A window starts at every ``STRIDE`` words and is two strides long.
    """
    return _vectors_of_strides(*_strides(codes_of), weights)


def _may_leak(
    ids: np.ndarray, steps: np.ndarray, text: np.ndarray, window: np.ndarray, passage: np.ndarray, block: Block
) -> np.ndarray:
    """Which candidates share enough words for ``is_leak``, as far as buckets tell.

    Candidates (text, window, passage) come in order of their windows. Words that share
    a bucket only add to what is shared, so no leak is lost.
    """
    may = np.zeros(len(window), bool)
    if not len(window):
        return may
    first = np.cumsum(steps) - steps
    new = np.append(True, (text[1:] != text[:-1]) | (window[1:] != window[:-1]))
    starts, row = np.flatnonzero(new), np.cumsum(new) - 1
    width = block.n_columns
    together = max(1, COSINES // max(width, WINDOW + 2 * STRIDE))
    for at in range(0, len(starts), together):
        own = starts[at : at + together]
        # a window is looked at with a stride on either side
        stride, of = window[own][:, None] + np.arange(-1, 3), text[own][:, None]
        inside = (stride >= 0) & (stride < steps[of])
        columns = block.columns[ids[np.where(inside, first[of] + stride, 0)]]
        columns[~inside] = 0
        met = np.zeros(len(own) * width, bool)
        lines = np.arange(len(own)) * width
        met[columns + lines[:, None, None]] = True
        met[lines] = False
        end = starts[at + together] if at + together < len(starts) else len(window)
        # a bounded number of candidates at a time
        for low in range(own[0], end, SHARED):
            part = slice(low, min(end, low + SHARED))
            places = block.own_columns[passage[part]] + lines[row[part] - at, None]
            # a passage has ``WINDOW`` words at most
            shared = met.take(places, mode="clip").view(np.uint8).sum(axis=1, dtype=np.uint8)
            may[part] = shared >= block.least[passage[part]]
    return may


def longest_common(place: dict[str, int], n: int, words: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over a passage.

    ``place`` has the places of each of its ``n`` words as bits.
    """
    full = (1 << n) - 1
    open_ = full
    for match in filter(None, map(place.get, words)):
        hit = open_ & match
        open_ = (open_ + hit | open_ - hit) & full
    return n - open_.bit_count()


def _places(words: list[str]) -> dict[str, int]:
    place: dict[str, int] = {}
    for i, word in enumerate(words):
        place[word] = place.get(word, 0) | 1 << i
    return place


def _stands_in(answer: list, words: list) -> bool:
    """Whether words stand one after the other among others."""
    return any(words[i : i + len(answer)] == answer for i, word in enumerate(words) if word == answer[0])


def is_leak(passage: list, place: dict, words: list, different: set | None = None) -> tuple[bool, float, bool]:
    """(leak, common share, answer found) of a passage and the words, or their hashes, around a window."""
    different = set(words) if different is None else different
    # words in common bound the subsequence from above
    shared = sum(map(int.bit_count, [place[w] for w in place.keys() & different]))
    if shared < COMMON_WITH_ANSWER * len(passage):
        return False, 0.0, False
    common = longest_common(place, len(passage), words) / len(passage)
    answer = passage[-ANSWER_WORDS:]
    found = common >= COMMON_WITH_ANSWER and _stands_in(answer, words)
    return common >= COMMON or found, common, found


def _seeded(codes_of: list[np.ndarray], block: Block, windows: np.ndarray) -> set[tuple[int, int, int]]:
    """(text, window, passage) wherever a run of words stands in a text and a passage.

    A window is looked at with what stands around it, so several have the run.
    """
    own = seeds(np.concatenate(codes_of))
    size = np.array([len(code) for code in codes_of])
    ends = np.cumsum(size)
    places = np.flatnonzero(block.maybe[own & np.uint64(len(block.maybe) - 1)])
    low, high = (np.searchsorted(block.seeds, own[places], side) for side in ("left", "right"))
    text = np.searchsorted(ends, places, "right")
    met = np.flatnonzero((low < high) & (places + SEED_WORDS <= ends[text]))  # runs end where their text ends
    text, low, n = text[met], low[met], (high - low)[met]
    within = places[met] - (ends - size)[text]
    first = np.maximum(0, -((WINDOW + STRIDE - SEED_WORDS - within) // STRIDE))
    last = np.minimum(windows[text] - 1, (within + STRIDE) // STRIDE)
    found = set()  # the runs of a copied passage meet in the same windows
    for i, first, last, low, n in zip(*(x.tolist() for x in (text, first, last, low, n))):
        found.update((i, window, p) for p in block.owner[low : low + n].tolist() for window in range(first, last + 1))
    return found


def _checked(text: str, code: np.ndarray, candidates: dict[tuple[int, int], float], block: Block) -> list[Leak]:
    """Leaks among the candidates (window, passage) of a text, with their cosines.

    Words are compared by their hashes first; only what leaks by them is compared as text.
    """
    best: dict[int, Leak] = {}
    at, words = -1, None
    for window, p in sorted(candidates):
        if window != at:
            at, cut = window, slice(max(0, window * STRIDE - STRIDE), window * STRIDE + WINDOW + STRIDE)
            around = code[cut].tolist()
            different = set(around)
        if not is_leak(block.codes[p], block.code_places[p], around, different)[0]:
            continue
        words = words_of(text) if words is None else words
        leak, common, found = is_leak(block.words[p], block.places[p], words[cut])
        item = int(block.item[p])
        if leak and (item not in best or common > best[item][2]):
            best[item] = item, candidates[window, p], common, found
    return [best[item] for item in sorted(best)]


def _leaks_together(found: list[tuple[str, np.ndarray]], block: Block, weights: np.ndarray) -> list[list[Leak]]:
    codes_of = [code for _, code in found]
    ids, steps = _strides(codes_of)
    vectors, windows = _vectors_of_strides(ids, steps, weights)
    text_of = np.repeat(np.arange(len(found)), windows)
    first = np.cumsum(windows) - windows
    candidates: list[dict[tuple[int, int], float]] = [{} for _ in found]
    step = max(1, COSINES // len(block.item))
    for at in range(0, len(vectors), step):
        cosine = vectors[at : at + step] @ block.vectors
        rows, passage = np.divmod(np.flatnonzero(cosine.ravel() >= CANDIDATE_COSINE), len(block.item))
        own = text_of[at + rows]
        window = at + rows - first[own]
        may = np.flatnonzero(_may_leak(ids, steps, own, window, passage, block))
        value = cosine[rows[may], passage[may]]
        for text, *near in zip(*(x.tolist() for x in (own[may], window[may], passage[may], value))):
            candidates[text][near[0], near[1]] = near[2]
    for i, window, p in _seeded(codes_of, block, windows):
        if (window, p) not in candidates[i]:
            candidates[i][window, p] = float(vectors[first[i] + window] @ block.vectors[:, p])
    return [_checked(*text, own, block) if own else [] for text, own in zip(found, candidates)]


def leaks_of(found: list[str], block: Block, weights: np.ndarray) -> list[list[Leak]]:
    """For each text the (item, cosine, common share, answer found) of items that leak into it.

    ``weights`` has the latent place of every bucket. Texts are worked out some together.
    """
    out: list[list[Leak]] = []
    for held in together(found):
        own = list(zip(held, codes_together(held)))
        long = [i for i, (_, code) in enumerate(own) if len(code) >= MIN_WORDS * COMMON_WITH_ANSWER]
        leaks: list[list[Leak]] = [[] for _ in held]
        if long:
            for i, of in zip(long, _leaks_together([own[i] for i in long], block, weights)):
                leaks[i] = of
        out += leaks
    return out


def _block(held: list[tuple[int, list[str]]], weights: np.ndarray) -> Block:
    words = [w for _, w in held]
    code = [codes(" ".join(w)) for w in words]
    vectors = np.array([weights[in_buckets(c)].sum(axis=0) for c in code])
    runs = [seeds(c) for c in code]
    owner, hashes = np.repeat(np.arange(len(runs)), [len(r) for r in runs]), np.concatenate(runs)
    order = np.argsort(hashes, kind="stable")
    maybe = np.zeros(min(MAX_SEED_TABLE, 1 << (SEED_ROOM * len(hashes)).bit_length()), bool)
    maybe[hashes & np.uint64(len(maybe) - 1)] = True
    items, listed = np.array([i for i, _ in held]), [c.tolist() for c in code]
    met = np.unique(in_buckets(np.concatenate(code)))
    columns = np.zeros(BUCKETS + 1, np.uint16)
    columns[met] = np.arange(1, len(met) + 1)
    own_columns = np.zeros((len(code), WINDOW), np.uint16)
    for own, c in zip(own_columns, code):
        own[: len(c)] = columns[in_buckets(c)]
    least = np.array([COMMON_WITH_ANSWER * len(c) for c in listed])
    places, code_places = [*map(_places, words)], [*map(_places, listed)]
    return Block(
        items, words, places, listed, code_places, columns, len(met) + 1, own_columns, least,
        _unit(vectors).T.copy(), hashes[order], owner[order], maybe,
    )


def _blocks(benchmark: DataFrame, weights: np.ndarray) -> Iterator[Block]:
    """Blocks of about ``BLOCK`` passages of the benchmark, which is the query set, one after the other."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").dropna()
    items = staged(items.orderBy("item_id", "text"), "benchmark-items")
    held = []
    for row in items.toLocalIterator():  # a partition at a time, and no more than a block is held
        held += passages([tuple(row)])
        if len(held) >= BLOCK:
            yield _block(held, weights)
            held = []
    if held:
        yield _block(held, weights)


def _weights(docs: DataFrame, benchmark: DataFrame) -> np.ndarray:
    """(BUCKETS, RANK): the latent place of every bucket."""
    passages = passage_buckets(texts(docs), "lsa-passages")
    idf, n = passage_frequencies(passages)
    return (idf[:, None] * latent_space(passages, n, benchmark, idf)).astype(np.float32)


def _by_block(docs: DataFrame, benchmark: DataFrame, search) -> Iterator[DataFrame]:
    """What ``search`` makes of each block, written before the next one is sent.

    ``search`` takes the broadcast block and weights; both are removed from
    driver and executors when they have been used.
    """
    context, weights = docs.sparkSession.sparkContext, _weights(docs, benchmark)
    placed = context.broadcast(weights)
    for block in _blocks(benchmark, weights):
        shared = context.broadcast(block)
        yield staged(search(shared, placed), "benchmark-leaks")
        shared.destroy()
    placed.destroy()


_LEAKS = "doc_id bigint, item_id bigint, cosine double, common double, answer boolean"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) of every document and item it holds.

    Items without an id, or of fewer than ``MIN_WORDS`` words, are not looked
    for. NULL and empty texts hold nothing; repeated rows and items give
    repeated results, rows without an id a NULL one. An empty table of either
    kind gives no rows.
    """

    def search(shared, placed) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                leaks = leaks_of(batch["text"].to_pylist(), shared.value, placed.value)
                rows = [(doc_id, *leak) for doc_id, own in zip(batch["doc_id"].to_pylist(), leaks) for leak in own]
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                columns = zip(*rows) if rows else [[] for _ in types]
                names = ["doc_id", "item_id", "cosine", "common", "answer"]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

        return texts(docs).mapInArrow(run, _LEAKS)

    found = list(_by_block(docs, benchmark, search))
    return reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], _LEAKS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, all columns kept.

    Rows of equal text stay or go together, whatever their ids; NULL and empty
    texts stay.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))

    def search(shared, placed) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = [*map(bool, leaks_of(batch["text"].to_pylist(), shared.value, placed.value))]
                yield batch.select(["digest"]).filter(pa.array(found, pa.bool_()))

        shown = docs.select(digest.alias("digest"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        return shown.mapInArrow(run, "digest binary")

    found = list(_by_block(docs, benchmark, search))
    if not found:
        return docs
    gone = staged(reduce(DataFrame.union, found).select(F.col("digest").alias("__gone")).distinct(), "benchmark-gone")
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_TEXTS else gone
    return docs.join(gone, digest == F.col("__gone"), "left_anti")
