"""Exact removal of passages that repeat across documents, by level-wise doubling of windows.

A word goes if a window of `length` words covers it whose words also start somewhere in a document
with a smaller id. Windows are counted at doubling lengths (for 13 words: 7, then 13). At the first
length each document offers, for every full window, the least hash of the short windows in it:
equal windows offer equal hashes, and neighbours mostly the same one. Only full windows whose offer
occurs in several documents are extended to the next length; levels end at the full length or when
nothing survives.

Documents are dealt into chunks of a bounded size of text. A chunk asks for each of its hashes once
(with the smallest and largest document that holds it), packed by hash range; a range of hashes is
answered by one call, and the answers go back to the chunks that asked. So a passage in a third of
all documents is asked for once per chunk, texts are shuffled once, and neither texts nor single
windows are ever gathered by key.

Windows are compared by 64 + 32 bits of hash. Null and empty texts have no words. Rows without id
lose nothing and count for no other; rows with equal ids do not count as smaller to each other.
Equal rows are folded to one with a count, so their number does not matter to a chunk.
An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.blobs import WordHashes, joined, packed, sliding_least, windows
from jobmetrics.llm.common import WORD, fold_equal_rows, small_batches, unfold

WINDOW_WORDS = 13
SHORTEST = 7  # windows are doubled from at most this length on
CHUNK_CHARS = 8_000_000
CHECK_BASE = 0xD6E8FEB86659FD93


def levels(length: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, each at most twice the one before, ending with `length`."""
    out = [length]
    while out[0] > shortest:
        out.insert(0, (out[0] + 1) // 2)
    return out


class Chunk:
    """The words of a chunk's documents, in the order of their ids, as one array of hashes."""

    def __init__(self, table: pa.Table):
        ids = table.column("doc_id").to_pylist()
        self.rows = sorted((k for k, x in enumerate(ids) if x is not None), key=lambda k: ids[k])
        texts, hashes = table.column("text"), WordHashes.shared()
        parts = [hashes.of_text(texts[k].as_py() or "") for k in self.rows]
        self.counts = np.array([len(p) for p in parts], dtype=np.int64)
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.docs = np.repeat(np.array([ids[k] for k in self.rows], dtype=np.int64), self.counts)
        self.ends = np.repeat(np.cumsum(self.counts), self.counts)

    def starts(self, length: int) -> np.ndarray:
        """Positions whose window stays within its document."""
        return np.flatnonzero(np.arange(len(self.words)) + length <= self.ends)

    def offers(self, length: int, short: int) -> np.ndarray:
        """Least short hash in the full window from each position on."""
        return sliding_least(windows(self.words, short), length - short + 1)


def _asked(hashes: np.ndarray, docs: np.ndarray, chunk: int, bits: int, checks: np.ndarray | None = None) -> pa.Table:
    """One row per range of hashes: each hash once, with its smallest and largest document."""
    order = np.argsort(hashes, kind="stable") if checks is None else np.lexsort((checks, hashes))
    h, d = hashes[order], docs[order]
    new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
    if checks is not None and len(h):
        c = checks[order]
        new |= np.r_[True, c[1:] != c[:-1]]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(h)][: len(first)] - 1
    h, low, high = h[first], d[first], d[last]
    c = c[first] if checks is not None and len(first) else np.zeros(len(first), np.int64)
    spot = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
    cuts = np.r_[np.flatnonzero(np.r_[True, spot[1:] != spot[:-1]]), len(h)] if len(h) else np.zeros(1, int)
    pieces = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table(
        {
            "spot": pa.array([int(spot[p.start]) for p in pieces], pa.int64()),
            "chunk": pa.array([chunk] * len(pieces), pa.int64()),
            "h": pa.array([packed(h[p]) for p in pieces], pa.binary()),
            "c": pa.array([packed(c[p]) for p in pieces], pa.binary()),
            "low": pa.array([packed(low[p]) for p in pieces], pa.binary()),
            "more": pa.array([packed(high[p] - low[p]) for p in pieces], pa.binary()),
        }
    )


def _answers(table: pa.Table) -> pa.Table:
    """To every chunk its hashes that several documents hold, with the smallest document of all."""
    h, c, low = joined(table.column("h")), joined(table.column("c")), joined(table.column("low"))
    high = low + joined(table.column("more"))
    sizes = [len(x) for x in map(_view, table.column("h").to_pylist())]
    asker = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((c, h))
    hs, cs = h[order], c[order]
    new = np.r_[True, (hs[1:] != hs[:-1]) | (cs[1:] != cs[:-1])]
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    least, most = np.minimum.reduceat(low[order], starts), np.maximum.reduceat(high[order], starts)
    several = (least < most)[group]
    # A chunk in which the hash occurs in its smallest document alone needs no answer for removal,
    # but its windows are to be extended all the same: the flag is the document itself.
    keep, first = order[several], least[group][several]
    back = np.lexsort((h[keep], asker[keep]))
    keep, first = keep[back], first[back]
    cuts = np.searchsorted(asker[keep], np.arange(len(sizes) + 1))
    rows = [k for k in range(len(sizes)) if cuts[k] < cuts[k + 1]]
    chunks = table.column("chunk").to_pylist()
    return pa.table(
        {
            "chunk": pa.array([chunks[k] for k in rows], pa.int64()),
            "h": pa.array([packed(h[keep[cuts[k] : cuts[k + 1]]]) for k in rows], pa.binary()),
            "c": pa.array([packed(c[keep[cuts[k] : cuts[k + 1]]]) for k in rows], pa.binary()),
            "first": pa.array([packed(first[cuts[k] : cuts[k + 1]]) for k in rows], pa.binary()),
        }
    )


def _view(cell: bytes) -> range:
    return range((len(cell) - 1) // 8)


def _find(answers: pa.Table, hashes: np.ndarray, checks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each hash whether it was answered, and the smallest document that holds it."""
    h, first = joined(answers.column("h")), joined(answers.column("first"))
    if not len(h):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    c = joined(answers.column("c"))
    order = np.lexsort((c, h))
    h, c, first = h[order].astype(np.uint64), c[order], first[order]
    at = np.minimum(np.searchsorted(h, hashes), len(h) - 1)
    if checks is not None:
        # Equal hashes with other checks are next to each other, and hardly ever occur.
        while (wrong := np.flatnonzero((h[at] == hashes) & (c[at] < checks) & (np.r_[h[1:], 0][at] == hashes))).size:
            at[wrong] += 1
    found = h[at] == hashes
    if checks is not None:
        found &= c[at] == checks
    return found, first[at]


def _checks(chunk: Chunk, length: int, starts: np.ndarray) -> np.ndarray:
    return (windows(chunk.words, length, CHECK_BASE)[starts] >> np.uint64(32)).astype(np.int64)


def remove_repeats(docs: DataFrame, length: int = WINDOW_WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space), and the columns `carry`."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(*dict.fromkeys(["doc_id", "text", *carry]))
    docs, chars, folded = fold_equal_rows(docs)
    bits = max(0, int(chars // CHUNK_CHARS).bit_length())
    kinds = dict(docs.dtypes)
    if folded:
        carry = (*carry, "_copies")
    also = [name for name in carry if name != "text"]
    chunk_of = F.pmod(F.xxhash64("doc_id", "text", *also), F.lit(1 << bits))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also, chunk_of.alias("chunk"))
    asked_as = "spot long, chunk long, h binary, c binary, low binary, more binary"
    answered_as = "chunk long, h binary, c binary, first binary"
    lengths = levels(length)

    def offer(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        at = chunk.starts(length)
        offers = chunk.offers(length, lengths[0])[at] if len(at) else np.zeros(0, np.uint64)
        docs_at = chunk.docs[at]
        new = np.r_[True, (offers[1:] != offers[:-1]) | (docs_at[1:] != docs_at[:-1])] if len(at) else np.zeros(0, bool)
        return _asked(offers[new], docs_at[new], table.column("chunk")[0].as_py(), bits)

    def extend(short: int, longer: int, by_offer: bool):
        """Ask for the windows of the next length whose shorter parts are in several documents."""

        def run(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows or not answers.num_rows:
                return _asked(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, bits)
            chunk = Chunk(table)
            if by_offer:
                at = chunk.starts(length)
                fine, _ = _find(answers, chunk.offers(length, short)[at])
                whole = np.zeros(len(chunk.words), bool)
                whole[at[fine]] = True
                # Every window of the next length that lies in such a full window.
                span = np.zeros(len(chunk.words) + 1, np.int64)
                np.add.at(span, at[fine], 1)
                np.add.at(span, at[fine] + length - longer + 1, -1)
                at = np.flatnonzero(np.cumsum(span[:-1]) > 0)
            else:
                parts = chunk.starts(short)
                fine, _ = _find(answers, windows(chunk.words, short)[parts], _checks(chunk, short, parts))
                ok = np.zeros(len(chunk.words), bool)
                ok[parts[fine]] = True
                at = chunk.starts(longer)
                at = at[ok[at] & ok[at + longer - short]]
            return _asked(
                windows(chunk.words, longer)[at], chunk.docs[at], table.column("chunk")[0].as_py(), bits,
                _checks(chunk, longer, at),
            )

        return run

    def answered(asked: DataFrame) -> DataFrame:
        return asked.groupBy("spot").applyInArrow(_answers, answered_as)

    answers = answered(rows.groupBy("chunk").applyInArrow(offer, asked_as))
    for k, (short, longer) in enumerate(zip(lengths, lengths[1:])):
        asked = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
            extend(short, longer, by_offer=k == 0), asked_as
        )
        answers = answered(asked)
    only_offers = len(lengths) == 1

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        gone = np.zeros(len(chunk.words) + 1, np.int64)
        at = chunk.starts(length)
        if answers.num_rows and len(at):
            checks = None if only_offers else _checks(chunk, length, at)
            found, first = _find(answers, windows(chunk.words, length)[at], checks)
            at = at[found & (first < chunk.docs[at])]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + length, -1)
        kept = np.cumsum(gone[:-1]) == 0
        begin = np.r_[0, np.cumsum(chunk.counts)]
        place = {row: k for k, row in enumerate(chunk.rows)}
        n_words, n_removed, texts = [], [], []
        for row, text in enumerate(table.column("text").to_pylist()):
            words = WORD.findall(text or "")
            if row in place:
                mask = kept[begin[place[row]] : begin[place[row] + 1]]
                if not mask.all():
                    n_words.append(len(words))
                    words = list(compress(words, mask.tolist()))
                    n_removed.append(n_words[-1] - len(words))
                    texts.append(" ".join(words))
                    continue
            n_words.append(len(words))
            n_removed.append(0)
            texts.append(" ".join(words))
        out = {
            "doc_id": table.column("doc_id"),
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_text": pa.array(texts, pa.string()),
        }
        return pa.table(out | {name: table.column(name) for name in carry})

    carried = "".join(f", `{name}` {kinds[name]}" for name in carry)
    done = rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        cut, f"doc_id long, n_words long, n_removed long, kept_text string{carried}"
    )
    done = done.withColumn("doc_id", F.col("doc_id").cast(kinds["doc_id"]))
    return unfold(done) if folded else done
