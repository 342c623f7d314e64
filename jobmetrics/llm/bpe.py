"""Byte-level BPE encoding by tree reduction, and decoding up the tree.

Encoding is a reduction over a monoid: the encodings of two adjacent byte strings are joined into
the encoding of both. A string is halved until the halves are short, the halves are encoded by
plain merging, and neighbours are joined: a window of tokens on both sides of the seam is encoded
again, and grows until it is stable. It is stable when its outer tokens and the untouched tokens
next to them are pairs that merging leaves alone: a token sequence in which merging leaves every
adjacent pair alone is the encoding of its bytes, and all other pairs lie inside one encoding.

Null texts count as empty; an empty text has no tokens. Rows are independent of each other.
"""

from __future__ import annotations

import base64
import heapq
import struct

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import map_batches, texts_of

# Halves of at most this many bytes are encoded by plain merging.
LEAF_BYTES = 32
# Strings of at most this many bytes are merged by scanning all pairs, longer ones with a heap.
SCAN_BYTES = 48
# Entries of the caches of a task; at this size they are emptied, which changes no result.
CACHE_ENTRIES = 400_000
# Tokens that one leaf of the decoding tree looks up.
LEAF_TOKENS = 4096


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class TreeEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.none = max(ranks.values(), default=0) + 1  # stands for a pair without rank
        self._calm: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain merging: always the adjacent pair of the lowest rank, the leftmost first."""
        n = len(data)
        if n == 1:
            return [self.ranks[data]]
        if n <= SCAN_BYTES:
            return self._scan(data)
        ranks = self.ranks
        after = list(range(1, n + 1))  # where the part that begins here ends
        before = list(range(-1, n))  # where the part before it begins
        alive = [True] * n
        heap = []
        for i in range(n - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            mid = after[i]
            if not alive[i] or mid >= n or after[mid] != end:
                continue
            alive[mid] = False
            after[i] = end
            if end < n:
                before[end] = i
                rank = ranks.get(data[i : after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            left = before[i]
            if left >= 0:
                rank = ranks.get(data[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[data[i : after[i]]])
            i = after[i]
        return ids

    def _scan(self, data: bytes) -> list[int]:
        """Plain merging of a short string: the ranks of all pairs are looked through each time."""
        rank_of, none = self.ranks.get, self.none
        cuts = list(range(len(data) + 1))
        pairs = [rank_of(data[i : i + 2], none) for i in cuts[:-2]]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            del pairs[i], cuts[i + 1]
            if i < len(pairs):
                pairs[i] = rank_of(data[cuts[i] : cuts[i + 2]], none)
            if i:
                pairs[i - 1] = rank_of(data[cuts[i - 1] : cuts[i + 1]], none)
        return [self.ranks[data[a:b]] for a, b in zip(cuts, cuts[1:])]

    def calm(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives these two tokens again."""
        pair = (left, right)
        found = self._calm.get(pair)
        if found is None:
            if len(self._calm) >= CACHE_ENTRIES:
                self._calm.clear()
            found = self._calm[pair] = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return found

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of `left` followed by those of `right`, both encodings."""
        if not left or not right:
            return left or right
        if self.calm(left[-1], right[0]):
            return left + right
        width = 1
        while True:
            a, b = left[-width:], right[:width]
            window = self.merge(b"".join(self.bytes_of[t] for t in a + b))
            open_left = len(a) < len(left) and not self.calm(left[-width - 1], window[0])
            open_right = len(b) < len(right) and not self.calm(window[-1], right[width])
            if not open_left and not open_right:
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode(self, data: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        if not data:
            return []
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tree(data)

    def decode(self, ids: tuple[int, ...]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.bytes_of[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class PieceCache(dict):
    """Ids of matches of the pattern as little-endian unsigned 32-bit integers; a new match is encoded when asked for."""

    def __init__(self, tree: TreeEncoder):
        super().__init__()
        self.tree = tree

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        found = self.tree.encode(piece.encode("utf-8"))
        ids = self[piece] = struct.pack(f"<{len(found)}I", *found)
        return ids


class TextEncoder:
    """Whole texts: every match of the pattern is encoded for itself; equal matches are encoded once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tree = TreeEncoder(ranks)
        self.split = regex.compile(pattern).findall
        self._ids_of = PieceCache(self.tree).__getitem__

    def packed(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._ids_of, self.split(text)))

    def unpacked(self, ids: bytes) -> bytes:
        return self.tree.decode(struct.unpack(f"<{len(ids) // 4}I", ids))


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit) of every row.

    `ranks_path` is read by each task and must exist on the executors, as the installed tokenizer does.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def make():
        encoder = TextEncoder(load_ranks(ranks_path), pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [encoder.packed(t) for t in texts_of(batch)]
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

        return step

    return map_batches(docs.select("doc_id", "text"), make, f"doc_id {kind}, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """`encoded` with the column decoded (binary) in addition; null ids count as none."""
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)

    def make():
        encoder = TextEncoder(load_ranks(ranks_path), r"")

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [encoder.unpacked(ids or b"") for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"]
            )

        return step

    return map_batches(encoded, make, f"{kinds}, decoded binary")


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode, decode, and keep hashes of both."""
    both = decode_documents(encode_documents(docs, ranks_path, pattern), ranks_path)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
