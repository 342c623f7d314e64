"""Packing of token pieces into sequences by bounded-space online best fit.

Documents become token ids followed by an end token; one longer than a sequence is cut from its
end, so only its first piece may be shorter. Pieces are dealt over tasks by a hash, and each task
packs the ones it gets in hash order: a piece goes into the open sequence with the least free space
that still holds it, else into a new one. A fixed number of sequences is open at once; a bitset
whose bit f says that one with f free tokens is open makes both "best fit" and "fullest" a few
integer operations. A full sequence closes; if one too many is open, the fullest closes.

Null and empty texts are documents of the end token alone. Repeated rows are packed each for
itself. An empty table gives an empty result. Ids of sequences are unique, not consecutive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import map_batches, small_batches, texts_of
from jobmetrics.session import materialise

# Sequences kept open in a task.
OPEN_SEQUENCES = 1024
# Sequences that a task fills, about: many more than it keeps open.
TASK_SEQUENCES = 4096
# Sequence ids are task number * this + number in the task.
SEQUENCES_PER_TASK = 1 << 40


class TokenIds:
    """Ids as the tokenizer file gives them: `marker` in a text is one token, the rest is split and merged."""

    def __init__(self, ranks_path: str, pattern: str, marker: str, marker_id: int):
        import tiktoken

        from jobmetrics.llm.bpe import load_ranks

        self.plain = tiktoken.Encoding(
            "packing", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={}
        ).encode_ordinary
        self.marker, self.marker_id = marker, marker_id

    def __call__(self, text: str) -> list[int]:
        if self.marker not in text:
            return self.plain(text)
        ids: list[int] = []
        for k, part in enumerate(text.split(self.marker)):
            if k:
                ids.append(self.marker_id)
            ids += self.plain(part)
        return ids


def cut(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: whole sequences from the end, what is left in front."""
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], len(ids)])]


def token_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, end_id: int, capacity: int = 1024,
    marker: str = "<|endoftext|>", marker_id: int = 50256,
) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, little-endian unsigned 32-bit) of every piece."""
    kind = dict(docs.dtypes)["doc_id"]

    def make():
        encode = TokenIds(ranks_path, pattern, marker, marker_id)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows, piece, start, length, packed = [], [], [], [], []
            for row, text in enumerate(texts_of(batch)):
                ids = np.array([*encode(text), end_id], dtype="<u4")
                for k, (s, n) in enumerate(cut(ids, capacity)):
                    rows.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    packed.append(ids[s : s + n].tobytes())
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

        return step

    return map_batches(
        docs.select("doc_id", "text"), make, f"doc_id {kind}, piece int, start long, length long, ids binary"
    )


class BestFit:
    """Open sequences by free space; `place` gives (sequence, offset) of a piece."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.bits = 0  # bit f: a sequence with f free tokens is open
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.count = self.next = 0

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            free, sequence = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            self.open[left].append(sequence)
            self.bits |= 1 << left
            self.count += 1
            if self.count > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        return sequence, self.capacity - free

    def _take(self, free: int) -> int:
        stack = self.open[free]
        sequence = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.count -= 1
        return sequence


def pack(pieces: DataFrame, capacity: int = 1024, open_sequences: int = OPEN_SEQUENCES) -> DataFrame:
    """`pieces` (with doc_id, piece, length) and the columns sequence_id and offset.

    Pieces of one task are sorted, so a task that is run again packs them the same way. The number
    of tasks follows from the total of tokens, for which the pieces are written first: each leaves at
    most its open sequences unfilled, and holds no more than those in memory.
    """
    spark = pieces.sparkSession
    small_batches(spark)
    pieces = materialise(pieces, "pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // (capacity * TASK_SEQUENCES)))
    mix = F.xxhash64("doc_id", "piece")
    dealt = (
        pieces.withColumn("_mix", mix)
        .repartition(tasks, "_mix")
        .sortWithinPartitions("_mix", *[c for c in pieces.columns])
        .drop("_mix")
    )
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = BestFit(capacity, open_sequences)
        base = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        for batch in batches:
            placed = [fit.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + s for s, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                ],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return dealt.mapInArrow(run, f"{kinds}, sequence_id long, offset long")
