"""Jaccard self-join of documents and its components, with token-combination prefixes.

A document is the set of its distinct shingles of some words (64-bit hashes). Two documents link at a
Jaccard similarity of a threshold or more; everything below follows from the two (`Measure`).
Documents with equal sets are one entry from the first step on.

Prefixes: tokens have one order for all documents: a share of them (by hash; a quarter at 0.9) by
document frequency, which is counted over all documents, then the others by hash. Similar documents
share a token among the first floor(n * (1 - threshold)) + 1. A token known to be rare is an index key
by itself; the others are frequent and are dealt by hash into classes, whose k-token combinations are
keys. As k - 1 tokens of each class may be shared without a common key, a prefix goes on until it has
as many tokens as above besides the first k - 1 frequent ones of every class (`Measure.keys`): then
similar documents share a rare token or k tokens of one class. The number of classes grows with the
set (by bands of sizes), so that each holds a few tokens of the prefix, whatever the set's length.

Candidates: members of a key are first compared with one leader of the key, in two rounds; what
these link needs no other comparison. All remaining pairs of a key in different components follow,
so that no link is lost. Before sets are intersected, pairs are dropped whose bucket sums (additive
fingerprints, folded to the same number of buckets) differ more often than similar sets can.

Null and empty texts have no set and link with nothing. Rows without id link with nothing and have
no component. Rows with one id are one document for links. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.llm.blobs import WordHashes, joined, mixed, packed, unpacked, windows
from jobmetrics.llm.common import fold_equal_rows, map_batches, small_batches, unfold
from jobmetrics.session import materialise

CHUNK_CHARS = 8_000_000
PORTION_BYTES = 4 << 20  # of texts, split into words at once
# A token in more sets than this is frequent; a key with more members is compared block by block.
FREQUENT = 32
BLOCK_ROWS = 2_000
# Tokens of a combination.
COMBINED = 2
LEADER_ROUNDS = 2


def _lower(text: str) -> str:
    """A-Z lower-cased, nothing else: what bytes.lower() does."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Measure:
    """Words of a shingle, and the threshold p / q, above 0 and below 1, in whole numbers."""

    words: int
    p: int
    q: int

    @classmethod
    def of(cls, words: int, threshold: float) -> Measure:
        share = Fraction(str(threshold))
        if words < 1 or not 0 < share < 1:
            raise ValueError("shingles need a word, and the threshold lies between 0 and 1")
        return cls(words, share.numerator, share.denominator)

    @property
    def counted(self) -> np.uint64:
        """One token in so many is counted and comes first in the order: more for longer prefixes."""
        return np.uint64(max(1, 2 * self.q // (5 * (self.q - self.p))))

    def shingles(self, text: str, hashes: WordHashes) -> np.ndarray:
        """The sorted set; fewer words than a shingle are one shingle of their own kind."""
        words = hashes.of_text(_lower(text))
        if len(words) >= self.words:
            return np.unique(windows(words, self.words))
        return mixed(windows(words, len(words)) + np.uint64(len(words))) if len(words) else words

    def links(self, common: int, union: int) -> bool:
        return self.q * common >= self.p * union

    def largest_partner(self, n):
        """Size of the largest set that can link with one of this size."""
        return n * self.q // self.p

    def allowed_difference(self, a: np.ndarray | int, b: np.ndarray | int):
        """Largest symmetric difference of linked sets of these sizes; negative if they cannot link."""
        total = a + b
        return total - 2 * np.maximum(-(-self.p * total // (self.p + self.q)), 0)

    def prefix(self, n: int) -> int:
        """Linked sets share a token among so many first ones."""
        return n * (self.q - self.p) // self.q + 1

    def bands(self, n: int) -> list[tuple[int, int]]:
        """Number and least size of the bands that a set of this size is in: the band of its own size,
        and the next one if a set there can link with it. Linked sets have a band in common."""
        number, edge = 0, 1
        while (after := max(2 * edge, self.largest_partner(edge) + 1)) <= n:
            number, edge = number + 1, after
        out = [(number, edge)]
        if self.largest_partner(n) >= after:
            out.append((number + 1, after))
        return out

    def classes(self, edge: int) -> tuple[int, int]:
        """Classes of frequent tokens in the band from this size on, and tokens of a combination: fewer
        where the smallest set of the band has too few tokens for its prefix to go on so far."""
        count, least = max(1, self.prefix(edge) - 1), -(-edge * self.p // self.q)
        size = COMBINED
        while size > 1 and least - count * (size - 1) < self.prefix(least):
            size -= 1
        return count, size

    def keys(self, s: np.ndarray, frequencies: dict[int, int]) -> np.ndarray:
        """The keys of one set, see `keys_of`."""
        counted = s[s % self.counted == 0]
        known = np.array([frequencies.get(h, 1) for h in counted.tolist()], dtype=np.int64)
        return self.keys_of(Sets(s, np.array([0, len(s)])), known)[1]

    def keys_of(self, sets: Sets, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each set rare tokens of the prefix, and combinations of its frequent ones by class.

        `known` are the frequencies of the sets' counted tokens. Returns numbers of sets, in order, and keys.

        Of two linked sets, let x be the one whose prefix ends first in the order. At most
        prefix(len(x)) - 1 of its tokens are not in the other set, so the tokens that end its prefix
        leave a shared rare one, or a class with enough shared ones for a combination.
        """
        n, told = np.diff(sets.at), sets.tokens % self.counted == 0
        often = np.full(len(sets.tokens), FREQUENT + 1, np.int64)
        often[told] = known
        # Counted tokens by frequency, then the others; the tokens of a set come in the order of their hashes.
        late = np.iinfo(np.int64).max
        order = np.lexsort((np.where(told, often, late), sets.numbers()))
        banded: dict[tuple[int, int, int], list[int]] = {}
        for k, size in enumerate(n.tolist()):
            for band, edge in _bands(self, size) if size else ():
                banded.setdefault((band, *self.classes(edge)), []).append(k)
        found = []
        for (band, count, size), some in banded.items():
            of = np.array(some)
            need = n[of] * (self.q - self.p) // self.q + 1
            longest = np.minimum(need + count * (size - 1), n[of])
            at = order[_places(sets.at[of], longest)]
            tokens, seen, item = sets.tokens[at], often[at], np.repeat(np.arange(len(of)), longest)
            frequent = np.flatnonzero(seen > FREQUENT)
            spread = (mixed(tokens[frequent] ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(20)) % np.uint64(count)
            class_ = item[frequent] * count + spread.astype(np.int64)
            by_class = np.argsort(class_, kind="stable")
            starts, sizes = _runs(class_[by_class])
            gain = np.ones(len(tokens), np.int64)
            gain[frequent[by_class]] = np.arange(len(by_class)) - np.repeat(starts, sizes) >= size - 1
            # A prefix ends where its gain is enough, or with the set.
            last, total = np.cumsum(longest), np.cumsum(gain)
            before = np.concatenate([[0], total[last - 1]])[:-1]
            end = np.minimum(np.searchsorted(total, before + need) + 1, last)
            inside = np.arange(len(tokens)) < end[item]
            rare = inside & (seen > 1) & (seen <= FREQUENT)
            found.append((of[item[rare]], tokens[rare]))
            members = frequent[by_class][inside[frequent[by_class]]]
            starts, sizes = _runs(class_[by_class][inside[frequent[by_class]]])
            for width in np.unique(sizes[sizes >= size]).tolist():
                first = starts[sizes == width]
                rows = np.sort(tokens[members[first[:, None] + np.arange(width)]], axis=1)
                chosen = rows[:, list(combinations(range(width), size))]
                key = np.full(chosen.shape[:2], band + 1, np.uint64)
                for k in range(size):
                    key = mixed(key ^ chosen[:, :, k])
                found.append((np.repeat(of[item[members[first]]], key.shape[1]), key.ravel()))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        number, key = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((key, number))
        number, key = number[order], key[order]
        new = np.concatenate([[True], (number[1:] != number[:-1]) | (key[1:] != key[:-1])])[: len(key)]
        return number[new], key[new]

    def fingerprint(self, s: np.ndarray) -> np.ndarray:
        """Sums of tokens by bucket, modulo 2**16; a power of two of buckets, more for larger sets."""
        buckets = 64
        while buckets * self.p < 4 * (self.q - self.p) * len(s):
            buckets *= 2
        spread = mixed(s ^ np.uint64(0xE7037ED1A0B428DB))
        bucket, low = (spread & np.uint64(buckets - 1)).astype(np.int64), (spread >> np.uint64(32)) & np.uint64(0xFFFF)
        return (np.bincount(bucket, weights=low, minlength=buckets).astype(np.uint64) & np.uint64(0xFFFF)).astype(np.uint16)


@dataclass(frozen=True)
class Sets:
    """The sorted sets of some documents one after the other, and where each begins and the last ends."""

    tokens: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, measure: Measure, texts: pa.ChunkedArray) -> Sets:
        """What `Measure.shingles` gives for each text, null ones without words; texts are taken some at a time."""
        parts, sizes, first, held = [], [np.zeros(1, np.int64)], 0, 0
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        for k, length in enumerate(lengths, 1):
            held += length
            if held >= PORTION_BYTES or k == len(lengths):
                tokens, n = _shingled(measure, texts.slice(first, k - first).combine_chunks())
                parts.append(tokens)
                sizes.append(n)
                first, held = k, 0
        return cls(np.concatenate([np.zeros(0, np.uint64), *parts]), np.cumsum(np.concatenate(sizes)))

    def numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def __getitem__(self, k: int) -> np.ndarray:
        return self.tokens[self.at[k] : self.at[k + 1]]


def _shingled(measure: Measure, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some texts, and the size of each."""
    cut = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, of_text = cut.flatten(), np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    some = pc.binary_length(words).to_numpy() > 0  # around white space at an end of a text is an empty word
    coded, of_text = words.filter(pa.array(some)).dictionary_encode(), of_text[some]
    different = coded.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, different), np.uint64, len(different))[coded.indices.to_numpy()]
    many = np.bincount(of_text, minlength=len(texts))
    begin = np.cumsum(many) - many
    sizes = np.where(many, np.maximum(many - measure.words + 1, 1), 0)
    at = np.concatenate([[0], np.cumsum(sizes)])
    tokens = np.empty(int(at[-1]), np.uint64)
    whole = many >= measure.words
    tokens[np.repeat(whole, sizes)] = windows(hashes, measure.words)[_places(begin[whole], sizes[whole])]
    for length in np.unique(many[~whole & (many > 0)]).tolist():
        short = many == length
        tokens[at[:-1][short]] = mixed(windows(hashes, length)[begin[short]] + np.uint64(length))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        tokens[a:b].sort()
    new = np.ones(len(tokens), bool)
    new[1:] = tokens[1:] != tokens[:-1]
    new[at[:-1][sizes > 0]] = True
    return tokens[new], np.bincount(np.repeat(np.arange(len(texts)), sizes)[new], minlength=len(texts))


@lru_cache(maxsize=10_000)
def _bands(measure: Measure, n: int) -> list[tuple[int, int]]:
    return measure.bands(n)


def _places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places from each start on, so many of each, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal values start, and their lengths."""
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return starts, np.diff(np.append(starts, len(ordered)))


def folded(v: np.ndarray, buckets: int) -> np.ndarray:
    while v.shape[-1] > buckets:
        half = v.shape[-1] // 2
        v = v[..., :half] + v[..., half:]
    return v


def _signed(h: np.ndarray) -> np.ndarray:
    return np.asarray(h, dtype=np.uint64).view(np.int64)


def _chunk_id(table: pa.Table) -> int:
    return table.column("chunk")[0].as_py()


SECOND = np.uint64(0x589965CC75374CC3)


def _content(s: np.ndarray) -> tuple[int, np.uint64, np.uint64]:
    """Size, and two sums that stand for the content of a set; the sums of an empty one are 0."""
    return len(s), np.bitwise_xor.reduce(mixed(s)), np.add.reduce(mixed(s ^ SECOND))


def _chosen(measure: Measure, table: pa.Table, firsts: pa.Table) -> tuple[list[int], Sets]:
    """Ids and sets of the chunk's documents that stand for all with their set."""
    wanted = joined(firsts.filter(pc.equal(firsts.column("kind"), 0)).column("h"))
    have = table.filter(pc.and_(pc.is_in(table.column("doc_id"), pa.array(wanted, pa.int64())), pc.is_valid(table.column("text"))))
    docs, sets = have.column("doc_id").to_pylist(), Sets.of(measure, have.column("text"))
    seen, rows = set(), Counter(table.column("doc_id").to_pylist())
    n, keep = np.diff(sets.at), []
    for k, doc in enumerate(docs):
        if n[k] and rows[doc] == 1:
            keep.append(k)
        elif n[k] and (content := (doc, *_content(sets[k]))) not in seen:
            seen.add(content)
            keep.append(k)
    if len(keep) == len(docs):
        return docs, sets
    keep = np.array(keep, np.int64)
    return [docs[k] for k in keep], Sets(sets.tokens[_places(sets.at[keep], n[keep])], np.concatenate([[0], np.cumsum(n[keep])]))


def _entries(measure: Measure, table: pa.Table, firsts: pa.Table):
    """(id, set) of the chunk's documents that stand for all with their set."""
    docs, sets = _chosen(measure, table, firsts)
    for k, doc in enumerate(docs):
        yield doc, sets[k]


def _describe(measure: Measure, table: pa.Table) -> pa.Table:
    """Size of every document's set, and two sums that stand for its content, as `_content` gives them."""
    sets = Sets.of(measure, table.column("text"))
    n = np.diff(sets.at)
    one, two, first = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), sets.at[:-1][n > 0]
    if len(first):
        one[n > 0] = np.bitwise_xor.reduceat(mixed(sets.tokens), first)
        two[n > 0] = np.add.reduceat(mixed(sets.tokens ^ SECOND), first)
    return pa.table(
        {
            "doc_id": table.column("doc_id"),
            "chunk": table.column("chunk"),
            "n": pa.array(n, pa.int64()),
            "s1": pa.array(_signed(one)),
            "s2": pa.array(_signed(two)),
            "_copies": table.column("_copies"),
        }
    )


_ASKED = "spot long, chunk long, h binary, count binary"
_ANSWER = "chunk long, kind int, h binary, count binary"


def _ask(measure: Measure, bits: int):
    """Counted tokens of the chunk's sets with the number of sets that hold them, by range of hashes."""

    def run(table: pa.Table, firsts: pa.Table) -> pa.Table:
        have = table.num_rows and firsts.num_rows
        tokens = _chosen(measure, table, firsts)[1].tokens if have else np.zeros(0, np.uint64)
        h, count = _runs_of(np.sort(tokens[tokens % measure.counted == 0]))
        spot = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
        cuts = np.r_[np.flatnonzero(np.r_[True, spot[1:] != spot[:-1]]), len(h)] if len(h) else np.zeros(1, int)
        pieces = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table(
            {
                "spot": pa.array([int(spot[p.start]) for p in pieces], pa.int64()),
                "chunk": pa.array([_chunk_id(table)] * len(pieces) if pieces else [], pa.int64()),
                "h": pa.array([packed(h[p]) for p in pieces], pa.binary()),
                "count": pa.array([packed(count[p]) for p in pieces], pa.binary()),
            }
        )

    return run


def _runs_of(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values, and how often each occurs."""
    starts, count = _runs(ordered)
    return ordered[starts], count


def _answer(table: pa.Table) -> pa.Table:
    """To every chunk those of its tokens that several sets hold, with their number."""
    cells = [unpacked(c) for c in table.column("h").to_pylist()]
    h, back = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.bincount(back, weights=joined(table.column("count"))).astype(np.int64)[back]
    rows, at = [], 0
    for chunk, cell in zip(table.column("chunk").to_pylist(), cells):
        part = total[at : at + len(cell)]
        at += len(cell)
        if (part > 1).any():
            rows.append((chunk, packed(cell[part > 1]), packed(part[part > 1])))
    return pa.table(
        {
            "chunk": pa.array([r[0] for r in rows], pa.int64()),
            "kind": pa.array([1] * len(rows), pa.int32()),
            "h": pa.array([r[1] for r in rows], pa.binary()),
            "count": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def _index(measure: Measure, table: pa.Table, answers: pa.Table) -> pa.Table:
    """Keys of every set that has any (kind 1), and the set with its fingerprint (kind 0)."""
    kind, doc_id, size, key, cell, print_ = [], [], [], [], [], []
    if table.num_rows and answers.num_rows:
        told = answers.filter(pc.equal(answers.column("kind"), 1))
        docs, sets = _chosen(measure, table, answers)
        hashes, counts = joined(told.column("h")).astype(np.uint64), joined(told.column("count"))
        order = np.argsort(hashes)
        hashes, counts = np.append(hashes[order], np.uint64(0)), np.append(counts[order], 0)
        # The sentinel at the end is never found: it is for tokens beyond the last.
        counted = sets.tokens[sets.tokens % measure.counted == 0]
        spot = np.searchsorted(hashes[:-1], counted)
        known = np.where((hashes[spot] == counted) & (spot < len(hashes) - 1), counts[spot], 1)
        number, every = measure.keys_of(sets, known)
        starts, many = _runs(number)
        for a, m in zip(starts.tolist(), many.tolist()):
            doc, s = docs[number[a]], sets[number[a]]
            kind += [0] + [1] * m
            doc_id += [doc] * (m + 1)
            size += [len(s)] * (m + 1)
            key += [0, *_signed(every[a : a + m]).tolist()]
            cell += [packed(s)] + [None] * m
            print_ += [measure.fingerprint(s).tobytes()] + [None] * m
    return pa.table(
        {
            "kind": pa.array(kind, pa.int32()),
            "doc": pa.array(doc_id, pa.int64()),
            "n": pa.array(size, pa.int64()),
            "key": pa.array(key, pa.int64()),
            "cell": pa.array(cell, pa.binary()),
            "print": pa.array(print_, pa.binary()),
        }
    )


def _pruned(measure: Measure, pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """The pairs (a, b) whose fingerprints differ in no more buckets than linked sets can."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for p, q, n, m in zip(*(batch.column(c).to_pylist() for c in ("pa", "pb", "na", "nb"))):
            x, y = np.frombuffer(p, np.uint16), np.frombuffer(q, np.uint16)
            least = min(len(x), len(y))
            keep.append(int((folded(x, least) != folded(y, least)).sum()) <= measure.allowed_difference(n, m))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = entries.select("doc", "n", "print")
    both = pairs.join(side.toDF("a", "na", "pa"), "a").join(side.toDF("b", "nb", "pb"), "b")
    return map_batches(both, lambda: step, "a long, b long")


def _linked(measure: Measure, pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """The pairs that link, by the whole sets."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for p, q in zip(batch.column("ca").to_pylist(), batch.column("cb").to_pylist()):
            x, y = unpacked(p), unpacked(q)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(measure.links(common, len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sets = entries.select("doc", "cell")
    both = _pruned(measure, pairs, entries).join(sets.toDF("a", "ca"), "a").join(sets.toDF("b", "cb"), "b")
    return map_batches(both, lambda: step, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """doc and label (smallest document reachable) of all documents with a link; each round is written."""
    both = materialise(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        around = both.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
        closer = labels.join(around, "a").select("a", "label", F.least("label", "near").alias("new"))
        jumped = closer.join(labels.toDF("new", "far"), "new", "left")
        labels = materialise(
            jumped.select("a", F.least("new", F.coalesce("far", "new")).alias("label"), F.col("label").alias("old")), "labels"
        )
        changed = not labels.where(F.col("label") != F.col("old")).isEmpty()
        labels = labels.select("a", "label")
        if not changed:
            return labels.toDF("doc", "label")


def _in_blocks(measure: Measure, rows: DataFrame) -> DataFrame:
    """Pairs of large keys' members in different components that pass the fingerprint test.

    `rows` has key, i, j, blk, doc, n, label, print. One call compares the blocks i and j of a key.
    """

    def run(table: pa.Table) -> pa.Table:
        left, right = set(), []
        key = table.column("key").to_numpy()
        i, j, block = (table.column(c).to_numpy() for c in ("i", "j", "blk"))
        doc, n, label = (table.column(c).to_numpy() for c in ("doc", "n", "label"))
        prints = [np.frombuffer(p, np.uint16) for p in table.column("print").to_pylist()]
        order = np.lexsort((n, j, i, key))
        new = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0] | np.r_[True, np.diff(i[order]) != 0] | np.r_[True, np.diff(j[order]) != 0])
        for a, b in zip(new, np.r_[new[1:], len(order)]):
            rows_ = order[a:b]
            sizes = n[rows_]
            width = np.array([len(prints[r]) for r in rows_])
            # Members are sorted by size: partners of a row follow it, with as many buckets or more.
            matrix = {int(w): np.stack([folded(prints[r], int(w)) for r in rows_[width >= w]]) for w in np.unique(width)}
            offset = {w: int((width < w).sum()) for w in matrix}
            ends = np.searchsorted(sizes, measure.largest_partner(sizes), side="right")
            for k in range(len(rows_)):
                end = ends[k]
                if end <= k + 1:
                    continue
                r, others, w = rows_[k], rows_[k + 1 : end], int(width[k])
                m, base = matrix[w], offset[w]
                apart = (m[k + 1 - base : end - base] != m[k - base]).sum(1)
                good = (apart <= measure.allowed_difference(sizes[k], sizes[k + 1 : end])) & (label[others] != label[r])
                if i[r] != j[r]:
                    good &= block[others] != block[r]
                for o in others[good].tolist():
                    pair = (min(doc[r], doc[o]), max(doc[r], doc[o]))
                    if pair[0] != pair[1]:
                        left.add(pair)
        right = sorted(left)
        return pa.table({"a": pa.array([int(p[0]) for p in right], pa.int64()), "b": pa.array([int(p[1]) for p in right], pa.int64())})

    return rows.groupBy("spot").applyInArrow(run, "a long, b long")


def _sizes_fit(measure: Measure, a: Column, b: Column) -> Column:
    return (a * measure.p <= b * measure.q) & (b * measure.p <= a * measure.q)


def _remaining(measure: Measure, keys: DataFrame, entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Every pair with a common key in different components, but for those the fingerprints exclude."""
    labelled = materialise(
        keys.join(labels, "doc", "left").select("key", "doc", "n", F.coalesce("label", "doc").alias("label")), "keys"
    )
    sizes = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where(F.col("low") < F.col("high")).select("key", "size")
    open_keys = materialise(labelled.join(sizes, "key"), "open-keys")
    few = open_keys.where(F.col("size") <= FREQUENT)
    other = few.select("key", F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    fits = _sizes_fit(measure, F.col("n"), F.col("nb"))
    pairs = (
        few.withColumnRenamed("doc", "a")
        .join(other, "key")
        .where((F.col("a") < F.col("b")) & (F.col("label") != F.col("lb")) & fits)
        .select("a", "b")
        .distinct()
    )
    many = open_keys.where(F.col("size") > FREQUENT).join(entries.select("doc", "print"), "doc")
    blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    # A row goes to every pair of blocks that holds its own.
    spread = (
        many.withColumn("blocks", blocks)
        .withColumn("blk", own)
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("blk", "with"))
        .withColumn("j", F.greatest("blk", "with"))
    )
    # As many groups as the copied rows need, about one for each pair of blocks.
    rows = open_keys.where(F.col("size") > FREQUENT).agg(F.sum(blocks)).first()[0] or 0
    spot = F.pmod(F.xxhash64("key", "i", "j"), F.lit(rows // BLOCK_ROWS + 1))
    large = _in_blocks(measure, spread.select("key", "i", "j", "blk", "doc", "n", "label", "print", spot.alias("spot")))
    return pairs.union(large).distinct()


def similar_documents(docs: DataFrame, shingle_words: int = 3, threshold: float = 0.9) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    measure = Measure.of(shingle_words, threshold)
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    docs, chars, folded = fold_equal_rows(docs.select("doc_id", "text"))
    bits = max(0, int(chars // CHUNK_CHARS).bit_length())
    kind = dict(docs.dtypes)["doc_id"]
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << bits)).alias("chunk")
    copies = F.col("_copies") if folded else F.lit(1).cast("long").alias("_copies")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", chunk, copies)

    def describe_step(table: pa.Table) -> pa.Table:
        return _describe(measure, table)

    described = materialise(
        rows.groupBy("chunk").applyInArrow(describe_step, "doc_id long, chunk long, n long, s1 long, s2 long, _copies long"), "sets"
    )
    content = ["n", "s1", "s2"]
    known = described.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    firsts = materialise(known.groupBy(*content).agg(F.min(F.struct("doc_id", "chunk")).alias("first")), "firsts")

    def list_firsts(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("doc_id").to_pylist(), dtype=np.int64)
        return pa.table(
            {
                "chunk": table.column("chunk")[:1],
                "kind": pa.array([0], pa.int32()),
                "h": pa.array([packed(ids)], pa.binary()),
                "count": pa.array([b"\x01"], pa.binary()),
            }
        )

    def index_step(table: pa.Table, answers: pa.Table) -> pa.Table:
        return _index(measure, table, answers)

    listed = firsts.select("first.doc_id", "first.chunk").groupBy("chunk").applyInArrow(list_firsts, _ANSWER)
    asked = rows.groupBy("chunk").cogroup(listed.groupBy("chunk")).applyInArrow(_ask(measure, bits), _ASKED)
    answers = asked.groupBy("spot").applyInArrow(_answer, _ANSWER)
    indexed = materialise(
        rows.groupBy("chunk")
        .cogroup(listed.union(answers).groupBy("chunk"))
        .applyInArrow(index_step, "kind int, doc long, n long, key long, cell binary, print binary"),
        "index",
    )
    entries = indexed.where(F.col("kind") == 0)
    keys = indexed.where(F.col("kind") == 1).select("key", "doc", "n")
    edges = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "doc long, label long")
    for turn in range(LEADER_ROUNDS):
        rank = F.struct((F.xxhash64("doc", F.lit(turn)) if turn else F.col("doc")).alias("rank"), "doc", "n")
        leaders = keys.groupBy("key").agg(F.min(rank).alias("_lead")).select(
            "key", F.col("_lead.doc").alias("lead"), F.col("_lead.n").alias("lead_n")
        )
        fits = _sizes_fit(measure, F.col("n"), F.col("lead_n"))
        pairs = keys.join(leaders, "key").where((F.col("doc") != F.col("lead")) & fits).select(
            F.least("doc", "lead").alias("a"), F.greatest("doc", "lead").alias("b")
        ).distinct()
        if turn:
            pairs = _apart(pairs, labels)
        edges = materialise(edges.union(_linked(measure, materialise(pairs, "pairs"), entries)), "links")
        labels = components(edges)
    rest = materialise(_remaining(measure, keys, entries, labels), "pairs")
    edges = materialise(edges.union(_linked(measure, rest, entries)), "links")
    labels = components(edges)
    by_content = firsts.select(*content, F.col("first.doc_id").alias("doc")).join(labels, "doc", "left")
    found = by_content.select(*content, F.coalesce("label", "doc").alias("label"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    labelled = described.join(found, content, "left")
    return (unfold(labelled) if folded else labelled).select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.cast(kind).alias("component_id"),
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    with_a = pairs.join(labels.toDF("a", "la"), "a", "left")
    with_b = with_a.join(labels.toDF("b", "lb"), "b", "left")
    return with_b.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")
