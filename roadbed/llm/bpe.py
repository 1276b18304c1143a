"""Byte-level BPE as a monoid: halves are encoded, then joined at the seam.

A token sequence is the encoding of its bytes exactly if every two neighbours
stay as they are when their bytes are encoded alone. Joining the encodings of
two halves can therefore re-encode a window around the seam only: once the
window's first and last token come out as they went in, all pairs outside it
are untouched and all pairs inside it are valid, so the whole is the encoding.
The window grows by doubling until then; it ends at the whole piece. Decoding
concatenates token bytes, which is a monoid as well.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from roadbed.llm.common import kept, slices, texts

RANKS = "byte_bpe_multi_50k.tiktoken"

_NEVER = 1 << 60

#: pieces up to this many bytes are leaves of the tree
LEAF_BYTES = 4
#: results of each kind a worker remembers, twice over
MEMO_ENTRIES = 150_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Memo:
    """Bounded memory in two generations: what is used again outlives the rest."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def put(self, key, value) -> None:
        if len(self.new) >= MEMO_ENTRIES:
            self.old, self.new = self.new, {}
        self.new[key] = value

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value


class TreeEncoder:
    """Encoder of one rank table; a worker keeps one."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.digits = {i: str(i) for i in self.token}
        self.find = regex.compile(pattern).findall
        self._pieces, self._spans, self._seams = Memo(), Memo(), Memo()

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        pieces = self._pieces
        for piece in self.find(text):
            found = pieces.new.get(piece) or pieces.get(piece)
            if found is None:
                found = self._whole(piece.encode("utf-8", "replace"))
                if len(piece) <= 64:
                    pieces.put(piece, found)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])

    def _whole(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)  # a piece that is a token is never merged
        return (rank,) if rank is not None else self.tree(piece)

    def tree(self, piece: bytes) -> tuple[int, ...]:
        """Encoding of ``piece`` by merges alone."""
        if len(piece) <= LEAF_BYTES:
            return self._span(piece)
        middle = len(piece) // 2
        return self.join(self.tree(piece[:middle]), self.tree(piece[middle:]))

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Encoding of two neighbours from theirs."""
        seam = (left[-1], right[0])
        window = self._seams.get(seam)
        if window is None:
            window = self._merge(self.token[seam[0]] + self.token[seam[1]])
            self._seams.put(seam, window)
        a = b = 1
        while True:
            fixed_left = a >= len(left) or window[0] == left[-a]
            fixed_right = b >= len(right) or window[-1] == right[b - 1]
            # one token that is neither edge's own leaves nothing proven
            whole = a >= len(left) and b >= len(right)
            if whole or (fixed_left and fixed_right and (len(window) > 1 or a >= len(left) or b >= len(right))):
                return left[: max(0, len(left) - a)] + window + right[b:]
            if not fixed_left:
                a = min(2 * a, len(left))
            if not fixed_right:
                b = min(2 * b, len(right))
            window = self._span(self.decode(left[len(left) - a :]) + self.decode(right[:b]))

    def _span(self, data: bytes) -> tuple[int, ...]:
        if len(data) > 32:
            return self._merge(data)
        found = self._spans.get(data)
        if found is None:
            found = self._merge(data)
            self._spans.put(data, found)
        return found

    def _merge(self, data: bytes) -> tuple[int, ...]:
        """Merges in order of rank, leftmost first, with a heap of pairs."""
        ranks = self.ranks
        n = len(data)
        if n <= 24:
            return self._merge_short(data)
        end = list(range(1, n + 1))  # end of the part that starts here
        back = list(range(-1, n - 1))
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop or end[i] >= stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                back[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := back[i]) >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        parts, i = [], 0
        while i < n:
            parts.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(parts)


    def _merge_short(self, data: bytes) -> tuple[int, ...]:
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], _NEVER) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < _NEVER:
            at = pairs.index(best)
            parts[at : at + 2] = [merged := parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + merged, _NEVER)
            if at < len(pairs):
                pairs[at] = rank(merged + parts[at + 1], _NEVER)
        return tuple([self.ranks[part] for part in parts])


_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    ``with_ids`` adds the token ids. ``path`` names a rank file every executor
    has. No row depends on another, so nothing is shuffled. NULL and empty texts
    have no tokens; repeated rows and rows without an id are encoded like
    others; an empty table gives no rows.
    """
    path = path or public_tokenizers.path(RANKS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(path, lambda: TreeEncoder(load_ranks(path)))
        digits = coder.digits
        for batch in slices(batches, 128, path):
            rows = []
            for text in batch["text"].to_pylist():
                ids = coder.encode(text)
                row = [
                    len(ids),
                    hashlib.sha256(",".join([digits[i] for i in ids]).encode()).hexdigest(),
                    hashlib.sha256(coder.decode(ids)).hexdigest(),
                ]
                rows.append([*row, ids] if with_ids else row)
            names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.record_batch([batch["doc_id"], *columns], ["doc_id", *names])

    schema = _SCHEMA + ", ids array<int>" * with_ids
    return texts(docs).mapInArrow(encode, schema)
