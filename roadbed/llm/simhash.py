"""SimHash near-duplicates: pigeonhole blocks, then Hamming distance.

A 64-bit fingerprint is cut into six blocks. Two differing bits touch two
blocks at most, so close fingerprints agree in four blocks whichever they are:
each of the 15 ways to leave out two blocks is a key, and fingerprints that
share a key are verified. Members of a key differ only in the 21 or 22 bits
left out, which bounds every group at 2**22 distinct fingerprints (32 MB); a
group gives links of a spanning forest, never all its pairs. Copies with the
same fingerprint count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadbed.llm.common import runs, slices, staged, texts
from roadbed.llm.components import connected_components

MAX_BITS = 2
_WIDTHS = (11, 11, 11, 11, 10, 10)
_SMALL = 64


def _block_masks() -> list[int]:
    masks, at = [], 0
    for width in _WIDTHS:
        masks.append(((1 << width) - 1) << at)
        at += width
    return masks


#: bits that two blocks hold together, for each choice of two
_FREE = [a | b for a, b in combinations(_block_masks(), 2)]


def fingerprint_of(text: str) -> int:
    """Unsigned SimHash over 3-word shingles with repeats; 0 without words.

    A-Z is lower-cased and words end at ASCII white space only, which is what
    ``bytes`` methods do.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < 3:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp holds the 64 bits as a signed number."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint_of(t) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.record_batch([batch["doc_id"], pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(score, "doc_id bigint, fp bigint")


def _forest(values: np.ndarray, free: int) -> np.ndarray:
    """Index of the smallest member each sorted distinct value is linked to."""
    root = np.arange(len(values))
    if len(values) <= _SMALL:
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= MAX_BITS
        passes = lambda: [np.nonzero(close)]
    else:
        bits = [1 << b for b in range(64) if free >> b & 1]
        masks = bits + [a | b for a, b in combinations(bits, 2)]
        passes = lambda: (_partners(values, np.uint64(m)) for m in masks)
    while True:
        before = root.copy()
        for i, j in passes():
            np.minimum.at(root, i, root[j])
        root = root[root]
        if (root == before).all():
            return root


def _partners(values: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    other = values ^ mask
    at = np.searchsorted(values, other)
    at[at == len(values)] = 0
    i = np.flatnonzero(values[at] == other)
    return i, at[i]


def _links_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (choice, _, fp), starts in runs(batches, 2):
        size = np.diff(starts)
        pair = np.flatnonzero(size == 2)
        left, right = fp[starts[pair]].view(np.uint64), fp[starts[pair] + 1].view(np.uint64)
        near = np.bitwise_count(left ^ right) <= MAX_BITS
        out = [(left[near], right[near])]
        for g in np.flatnonzero(size > 2):
            at = starts[g]
            values = np.unique(fp[at : starts[g + 1]].view(np.uint64))
            root = _forest(values, _FREE[choice[at]])
            linked = root != np.arange(len(values))
            out.append((values[linked], values[root[linked]]))
        a, b = (np.concatenate(side).view(np.int64) for side in zip(*out))
        yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """(a, b): links within ``MAX_BITS`` that join all close distinct fingerprints."""
    keys = [
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(_signed(~free)).alias("key"))
        for i, free in enumerate(_FREE)
    ]
    keyed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.choice", "k.key", "fp")
    dealt = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key")
    return dealt.mapInArrow(_links_in_groups, "a bigint, b bigint")


def _signed(bits: int):
    bits &= 2**64 - 1
    return F.lit(bits - 2**64 if bits >> 63 else bits).cast("bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``component_id`` is the smallest doc_id reachable over links. Rows without
    words have fingerprint 0 and are linked like others. Repeated rows give
    repeated results; rows with a NULL id take part and never name a component
    unless no other row is in it, when it is NULL. An empty table gives no rows.
    """
    rows = staged(fingerprints(docs), "simhash")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    roots = connected_components(fingerprint_links(distinct))
    named = distinct.join(roots, distinct.fp == roots.node, "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = named.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose document is the smallest id of its group.

    Rows that repeat an id are one document and stay or go together; rows
    without an id stay.
    """
    found = near_duplicates(docs).filter(F.col("doc_id") != F.col("component_id"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
