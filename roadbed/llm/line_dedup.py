"""Near-duplicate lines: segment-partition join under an edit distance.

A line that ``e`` edits may change (fewer for shorter lines, see ``edits_of``)
is cut into ``e`` + 1 segments. A line within these edits of it has at least one of these segments unchanged, shifted by no more than the edits
around it allow; so every line is indexed by its segments and probes, for each
length in reach, the substrings that can match one. A probe and an indexed line
meet by the hash of (length, segment number, segment). A bit mask travels with
them: an edit changes the parity of at most two letter counts, so most chance
meetings end without their texts being read.
What is left is verified on the texts by a banded bit-parallel edit distance.
Few lines under a key send their pairs on to be verified. A crowded key sends
its lines instead: with their texts they meet again in cells of bounded size,
are verified there, and only counts and the links of a spanning forest leave.
A pair under several keys counts at the smallest. Equal lines of any length are
one class by their hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import INDEX, PROBE, in_cells, runs, slices, staged, texts
from roadbed.llm.components import connected_components

#: lines this many edits apart are the same line
EDITS = 2
#: lines of fewer characters, which are empty ones, are left alone
MIN_CHARS = 1
#: shorter lines allow one edit less for each step: a few edits make another line of them
FULL_CHARS, ONE_CHARS = 24, 12
#: a document goes when this share of its characters repeats others: all of them
REDUNDANT = 1.0
#: lines under a key whose pairs are sent on; of more, the lines are
CROWD = 32
#: lines of a crowded key that are verified in one task
CELL = 1000
#: hashes of lines a task remembers, so as to send copies once
MAX_SEEN = 1_000_000
#: ids of candidate lines are broadcast up to this many (16 MB), else joined
MAX_BROADCAST_IDS = 1_000_000


def edits_of(n: int) -> int:
    """Edits that keep two lines the same, if the shorter has ``n`` characters."""
    return max(0, EDITS - (n < FULL_CHARS) - (n < ONE_CHARS))


def segments(n: int) -> list[tuple[int, int]]:
    """(start, length) of the segments of a line of ``n`` characters."""
    edits = edits_of(n)
    short, more = divmod(n, edits + 1)
    out, at = [], 0
    for i in range(edits + 1):
        size = short + (i > edits - more)
        out.append((at, size))
        at += size
    return out


def probes(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(indexed length, segment, start, length): substrings that can match a segment.

    Lines of equal or smaller length are probed. With ``i`` segments before it
    a match may be shifted by ``i`` edits at most, and by what the segments
    behind it leave over of the difference in length.
    """
    for other in range(max(MIN_CHARS, n - EDITS), n + 1):
        longer, edits = n - other, edits_of(other)
        if not edits or longer > edits:
            continue
        for i, (start, size) in enumerate(segments(other)):
            behind = edits - i
            low = max(0, start - i, start + longer - behind)
            high = min(n - size, start + i, start + longer + behind)
            for at in range(low, high + 1):
                yield other, i, at, size


def masks(lines: list[str]) -> np.ndarray:
    """Parities of letter counts, in 32 classes of letters, by line."""
    text = "\n".join(lines) + "\n"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    border = codes == 10
    bits = np.where(border, np.uint32(0), np.uint32(1) << (codes & np.uint32(31)))
    starts = np.append(0, np.flatnonzero(border)[:-1] + 1)
    return np.bitwise_xor.reduceat(bits, starts)


def may_be_close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """False only for lines more than ``EDITS`` edits apart."""
    return np.bitwise_count(a ^ b) <= 2 * EDITS


def _common(a: str, b: str) -> int:
    """Length of the common start."""
    start, stop = 0, min(len(a), len(b))
    while start < stop:
        step = (stop - start + 1) // 2
        if a[start : start + step] == b[start : start + step]:
            start += step
        elif step == 1:
            break
        else:
            stop = start + step
    return start


def edit_distance(a: str, b: str, most: int = EDITS) -> int | None:
    """Edit distance if it is at most ``most``, else None.

    Equal ends are cut off. Over the rest, level k holds as bits which places of
    ``b`` are reached with k edits, within the band of 2 * most + 1 diagonals:
    after i letters of ``a``, bit p stands for i - most + p letters of ``b``.
    """
    if abs(len(a) - len(b)) > most:
        return None
    cut = _common(a, b)
    a, b = a[cut:], b[cut:]
    cut = _common(a[::-1], b[::-1])
    a, b = a[: len(a) - cut], b[: len(b) - cut]
    where: dict[str, int] = {}
    for j, letter in enumerate(b):
        where[letter] = where.get(letter, 0) | 1 << j
    band = (1 << 2 * most + 1) - 1
    levels = [((1 << k + 1) - 1) << most & band for k in range(most + 1)]
    for i, letter in enumerate(a):
        match = where.get(letter, 0)
        match = match >> i - most if i > most else match << most - i
        old = new = 0
        for k in range(most + 1):
            fewer_old, fewer_new, old = old, new, levels[k]
            new = old & match
            if k:  # left out, replaced, put in
                new |= fewer_old >> 1 | fewer_old | fewer_new << 1 & band
            levels[k] = new
        if not new:
            return None
    place = len(b) - len(a) + most
    return next((k for k, level in enumerate(levels) if level >> place & 1), None)


@lru_cache(maxsize=4096)
def _cuts(n: int) -> list[tuple[int, int, int, int]]:
    """(seed, start, end, kind) in bytes of UTF-32: what a line of ``n`` sends."""
    kinds: dict[tuple[int, int, int], int] = {}
    for i, (at, size) in enumerate(segments(n) if edits_of(n) else []):
        kinds[n * 8 + i, at, size] = INDEX
    for other, i, at, size in probes(n):
        key = other * 8 + i, at, size
        kinds[key] = kinds.get(key, 0) | PROBE
    return [(seed, 4 * at, 4 * (at + size), kind) for (seed, at, size), kind in kinds.items()]


def _keys_of(line: str) -> dict[int, int]:
    """Kind by key of one line."""
    data, found = line.encode("utf-32-le", "surrogatepass"), {}
    for seed, start, end, kind in _cuts(len(line)):
        key = xxhash.xxh64_intdigest(data[start:end], seed)
        key -= key >> 63 << 64  # signed, as in Spark
        found[key] = found.get(key, 0) | kind
    return found


def _first_key(a: dict[int, int], b: dict[int, int]) -> int | None:
    """Smallest key under which two lines meet: one is looked up, the other looks up."""
    return min((k for k in a.keys() & b.keys() if a[k] & INDEX and b[k] & PROBE or a[k] & PROBE and b[k] & INDEX), default=None)


def _are_close(a: str, b: str) -> bool:
    return a != b and edit_distance(a, b, edits_of(min(len(a), len(b)))) is not None


_KEYED = "key bigint, id bigint, mask int, kind tinyint"


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index and probe keys of lines; copies within a task send theirs once."""
    seen: set[int] = set()
    digest = xxhash.xxh64_intdigest
    for batch in slices(batches, 2048):
        if len(seen) > MAX_SEEN:
            seen.clear()
        ids, lines = [], []
        for h, line in zip(batch["h1"].to_pylist(), batch["line"].to_pylist()):
            if h not in seen:
                seen.add(h)
                ids.append(h)
                lines.append(line)
        if not lines:
            continue
        keys, sizes, kinds = [], [], []
        for line in lines:
            data, cuts = line.encode("utf-32-le", "surrogatepass"), _cuts(len(line))
            keys += [digest(data[a:b], seed) for seed, a, b, _ in cuts]
            kinds += [cut[3] for cut in cuts]
            sizes.append(len(cuts))
        columns = [
            np.array(keys, np.uint64).view(np.int64), np.repeat(np.array(ids, np.int64), sizes),
            np.repeat(masks(lines).view(np.int32), sizes), np.array(kinds, np.int8),
        ]
        yield pa.record_batch([pa.array(c) for c in columns], ["key", "id", "mask", "kind"])


_MET = "key bigint, a bigint, b bigint, kind tinyint"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of lines under one key whose masks allow them to be close.

    A key of more than ``CROWD`` lines gives its lines (``a``) and their kinds, once each.
    """

    def told(key, a, b, kind):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int8()]
        return pa.record_batch([pa.array(c, t) for c, t in zip((key, a, b, kind), types)], ["key", "a", "b", "kind"])

    for (keys, ids, mask, kind), starts in runs(batches, 1):
        if starts[-1] == 0:
            continue
        first = starts[:-1]
        differ = np.maximum.reduceat(ids, first) != np.minimum.reduceat(ids, first)
        mask, out = mask.view(np.uint32), []
        for g in np.flatnonzero(differ):
            own = np.arange(starts[g], starts[g + 1])
            if len(own) > CROWD:
                lines, at = np.unique(ids[own], return_inverse=True)
                if len(lines) > CROWD:
                    kinds = np.zeros(len(lines), np.int8)
                    np.bitwise_or.at(kinds, at, kind[own])
                    for i in range(0, len(lines), 1 << 16):
                        some = lines[i : i + (1 << 16)]
                        yield told([keys[own[0]]] * len(some), some, [None] * len(some), kinds[i : i + (1 << 16)])
                    continue
            index, probe = own[kind[own] & INDEX > 0], own[kind[own] & PROBE > 0]
            for i in range(0, len(index), 1024):
                for j in range(0, len(probe), 1024):
                    a, b = index[i : i + 1024], probe[j : j + 1024]
                    x, y = np.nonzero(may_be_close(mask[a][:, None], mask[b][None, :]))
                    out.append(np.stack([keys[a[x]], ids[a[x]], ids[b[y]]]))
        if out:
            pairs = np.concatenate(out, axis=1)
            pairs[1:] = np.sort(pairs[1:], axis=0)
            pairs = np.unique(pairs, axis=1)
            pairs = pairs[:, pairs[1] != pairs[2]]
            yield told(*pairs, np.zeros(pairs.shape[1], np.int8))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that are close and do not meet under a smaller key, where they count."""
    for batch in slices(batches, 4096):
        a, b = batch["line_a"].to_pylist(), batch["line_b"].to_pylist()
        close = [
            _are_close(x, y) and _first_key(_keys_of(x), _keys_of(y)) == key
            for x, y, key in zip(a, b, batch["key"].to_pylist())
        ]
        yield batch.select(["a", "b"]).filter(pa.array(close, pa.bool_()))


def _find(root: list[int], i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _cell(key: int, nodes: np.ndarray, lines: np.ndarray, kind: np.ndarray, role: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Forest links and numbers of close lines of the lines of one cell."""
    lines, mask = lines.tolist(), masks(lines.tolist())
    keys = [_keys_of(line) for line in lines]
    root, degree, links = list(range(len(lines))), np.zeros(len(lines), np.int64), []
    probe = np.flatnonzero(role & PROBE)
    for i in np.flatnonzero(role & INDEX):
        for j in probe[may_be_close(mask[i], mask[probe])]:
            # lines that both look up and are looked up meet either way round
            both = kind[i] & PROBE and kind[j] & INDEX
            if nodes[i] == nodes[j] or both and nodes[i] > nodes[j]:
                continue
            if not _are_close(lines[i], lines[j]) or _first_key(keys[i], keys[j]) != key:
                continue
            degree[i] += 1
            degree[j] += 1
            x, y = _find(root, i), _find(root, j)
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((i, j))
    return links, degree


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n): forest links (n is NULL), and lines (a) with their numbers of close lines."""
    for (key, _, nodes, lines, kind, role), starts in runs(batches, 2):
        for at, end in zip(starts[:-1], starts[1:]):
            links, degree = _cell(int(key[at]), *(column[at:end] for column in (nodes, lines, kind, role)))
            own, met = nodes[at:end], np.flatnonzero(degree)
            a = [own[i] for i, _ in links] + own[met].tolist()
            b = [own[j] for _, j in links] + [None] * len(met)
            n = [None] * len(links) + degree[met].tolist()
            yield pa.record_batch([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(n, pa.int64())], ["a", "b", "n"])


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def split_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, h1, h2): all lines but empty ones.

    White space at the ends is left out; two hashes stand for the text.
    """
    lines = texts(docs).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    lines = lines.withColumn("line", _trimmed(F.col("line"))).filter(F.char_length("line") >= MIN_CHARS)
    return lines.select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _node() -> Column:
    return F.concat_ws(":", "h1", "h2")


def line_links(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that join all different lines within ``edits_of`` the shorter, and
    (node, n_links) with the number of such lines of each; a line is "h1:h2"."""
    keyed = lines.select("h1", "line").mapInArrow(_keys, _KEYED)
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    met = staged(dealt.mapInArrow(_meet, _MET), "line-met")
    crowd = met.filter("b is null").select("key", F.col("a").alias("h1"), "kind")
    # under the first of their small keys; the true first one may be crowded
    pairs = staged(met.filter("b is not null").groupBy("a", "b").agg(F.min("key").alias("key")), "line-pairs")
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("h1")).union(crowd.select("h1")).distinct(), "line-ids")
    wanted = F.broadcast(ids) if ids.count() <= MAX_BROADCAST_IDS else ids
    told = lines.select("h1", "h2", "line").join(wanted, "h1").dropDuplicates(["h1", "h2"])
    told = staged(told.select("h1", _node().alias("node"), "line"), "line-texts")
    left = told.select(F.col("h1").alias("ha"), F.col("node").alias("a"), F.col("line").alias("line_a"))
    right = told.select(F.col("h1").alias("hb"), F.col("node").alias("b"), F.col("line").alias("line_b"))
    both = pairs.select("key", F.col("a").alias("ha"), F.col("b").alias("hb")).join(left, "ha").join(right, "hb")
    few = both.select("key", "a", "b", "line_a", "line_b").mapInArrow(_verify, "a string, b string")
    few = staged(few, "line-links")
    cells = in_cells(crowd.join(told, "h1").select("key", "node", "line", "kind"), "node", CELL)
    cells = cells.repartition("key", "cell").sortWithinPartitions("key", "cell")
    many = staged(cells.mapInArrow(_crowded, "a string, b string, n bigint"), "line-crowds")
    links = few.union(many.filter("b is not null").select("a", "b"))
    one = F.lit(1).cast("bigint").alias("n")
    counts = few.select(F.explode(F.array("a", "b")).alias("node"), one).union(many.filter("b is null").select("a", "n"))
    return links, counts.groupBy("node").agg(F.sum("n").alias("n_links"))


def line_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, class_doc, class_line, n_links, keep) of every line that is not empty.

    Lines are one class if equal or joined by links; (class_doc, class_line) is
    the first place of any of them, in order of doc_id (NULL first) and line,
    and ``keep`` marks it. ``n_links`` counts different lines within
    ``edits_of`` the shorter. Rows that repeat an id are one document. NULL and
    empty texts give no rows.
    """
    lines = split_lines(docs)
    links, degree = line_links(lines)
    places = staged(lines.select("doc_id", "line_no", "h1", "h2"), "line-places")
    first = F.min(F.struct("doc_id", "line_no"))
    copies = staged(places.groupBy("h1", "h2").agg(first.alias("first"), F.count("*").alias("n")), "line-copies")
    tied = connected_components(links).join(degree, "node")
    linked = copies.withColumn("node", _node()).join(tied, "node").select("h1", "h2", "first", "root", "n_links")
    linked = staged(linked, "line-linked")
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    linked = linked.join(heads, "root").select("h1", "h2", "head", "n_links")
    repeated = copies.filter("n > 1").join(linked, ["h1", "h2"], "left_anti")
    classes = linked.union(repeated.select("h1", "h2", F.col("first").alias("head"), F.lit(0).cast("bigint")))
    own = F.struct("doc_id", "line_no")
    found = places.join(classes, ["h1", "h2"], "left").withColumn("head", F.coalesce("head", own))
    return found.select(
        "doc_id", "line_no", F.col("head.doc_id").alias("class_doc"), F.col("head.line_no").alias("class_line"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.col("head").eqNullSafe(own).alias("keep"), "h1",
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without lines that repeat an earlier one; ``n_chars`` follows.

    A document goes only when no line of its own is left. Rows without an id, and NULL texts, stay as they are.
    """
    # rows without an id stay as they are
    gone = line_classes(docs).filter(~F.col("keep") & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("__id"))
    # at most the lines of one document
    gone = gone.agg(F.collect_set(F.concat_ws(":", "line_no", "h1")).alias("__gone"))
    pieces = F.split("text", "\n", -1)
    # a hash set, as a document may have very many lines
    places = F.transform(pieces, lambda x, i: F.concat_ws(":", i, F.xxhash64(_trimmed(x))))
    places = F.array_except(places, F.col("__gone"))
    kept = F.transform(places, lambda p: F.get(pieces, F.substring_index(p, ":", 1).cast("int")))
    joined = docs.join(gone, docs["doc_id"] == gone["__id"], "left")
    text = F.when(F.col("__gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    cut = joined.withColumn("__kept", text)
    size = lambda c: F.length(F.translate(c, "\n \t\r", ""))
    cut = cut.filter(F.col("__gone").isNull() | (size("__kept") > (1 - REDUNDANT) * size("text")))
    cut = cut.withColumn("text", F.col("__kept"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)
