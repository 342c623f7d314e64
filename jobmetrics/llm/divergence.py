"""How the sources of a language differ: terms counted by chunk factorization, then exact divergences.

A chunk is a run without ASCII white space. Documents are gathered into blocks of a bounded size, and
a block lists for each of its chunks the documents that hold it and how often. The lists are dealt by
chunk, where every globally distinct chunk is cut into terms once, and go back by slice of terms. There
the lists of one term are united, which counts its distinct documents (of several chunks with one term)
and its occurrences; sums over blocks follow. Lists travel packed, many chunks in a row. No group grows
with the corpus: the lists of a block are bounded, and buckets of chunks grow in number; a chunk or
term that is everywhere is one entry for each block, and a task unites at most `STRIPE_BLOCKS` of them.

The terms a language keeps are those in at least `min_docs` of its documents; rows are documents, so
repeated rows count repeatedly. For every kept term a group (language and source), and a language as a
whole, has a smoothed share in billionths, p = 1 + floor(10^9 * (count + 2) / (N + 2 * V)), and two
shares differ by floor((p - q)^2 / (p + q)). All of it is integer arithmetic. A source is compared with
each other source of its language, over all kept terms: pairs of sources are few beside the documents,
and only counts above zero are joined, since the rest of a sum follows from what remains.

Null texts, languages and sources count as ''. Texts without terms only make their group occur.
Languages without kept terms give pairs with value 0 and no terms. No documents give no rows.
"""

from __future__ import annotations

import contextvars
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.session import materialise, scratch_scope

# Runs of ASCII letters and anything beyond ASCII; A-Z are lower-cased.
# As bytes: UTF-8 has bytes below 0x80 for ASCII only.
TERM_BYTES = bytes(c if re.match(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]", bytes([c])) else 32 for c in bytes(range(256)).lower())
MIN_DOCS = 10
TOP_TERMS = 10
# A block ends at so many bytes of text or documents; a document's number in it has 16 bits.
BLOCK_BYTES = 12 << 20
BLOCK_DOCS = 1 << 16
PIECE_BYTES = 4 << 20  # of texts, split into chunks at once
BUCKET_CHUNKS = 250_000  # chunks, counted once for each block, that are dealt to one bucket
LEAST_BUCKETS = 64
SLICES = 64  # of the terms, by hash
STRIPE_BLOCKS = 64  # blocks whose lists of a slice go to one task
MOST = np.iinfo(np.uint16).max

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(text: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in pieces that end at white space."""
    start = 0
    while len(text) - start > size:
        space = _SPACE.search(text, start + size)
        end = space.end() if space else len(text)
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs without ASCII white space of all texts, which are bytes, and the number of the text of each."""
    cut = pc.ascii_split_whitespace(texts.view(pa.string()))
    words, of_text = cut.flatten(), np.repeat(np.arange(len(texts)), np.diff(cut.offsets.to_numpy()))
    # Around white space at an end of a text is an empty run.
    some = pc.binary_length(words).to_numpy() > 0
    return (words, of_text) if some.all() else (words.filter(pa.array(some)), of_text[some])


def _numbered(parts: list[pa.Array]) -> tuple[pa.Array, np.ndarray]:
    """The distinct ones of many names, and the number of each name among them."""
    coded = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64)


def _blob(names: pa.Array) -> bytes:
    """Names one after the other, between spaces."""
    together = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
    return pc.binary_join(together, " ")[0].as_buffer().to_pybytes()


def _bytes_of(names: pa.Array) -> list[bytes]:
    return names.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _hashes(names: pa.Array) -> np.ndarray:
    return np.fromiter(map(crc32, _bytes_of(names)), np.int64, len(names))


def _entries_of(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places from each start on, so many of each, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


class Lists:
    """Names (chunks or terms, joined by spaces) and the entries of each: documents and counts."""

    def __init__(self, blob: bytes, sizes: np.ndarray, docs: np.ndarray, counts: np.ndarray):
        self.blob, self.sizes, self.docs, self.counts = blob, sizes, docs, counts
        self.at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])

    @classmethod
    def unpacked(cls, row: dict) -> Lists:
        kinds = (("sizes", np.uint32), ("docs", np.uint16), ("counts", np.uint16))
        return cls(row["names"], *(np.frombuffer(row[c], k) for c, k in kinds))

    def packed(self) -> dict:
        return {"names": self.blob, "sizes": self.sizes.tobytes(), "docs": self.docs.tobytes(), "counts": self.counts.tobytes()}

    def names(self) -> pa.Array:
        return words_of(pa.array([self.blob], pa.binary()))[0]

    def cut(self, bounds: np.ndarray) -> Iterator[tuple[int, dict]]:
        """The parts between neighbouring bounds that hold a name, each as packed cells."""
        spaces = np.flatnonzero(np.frombuffer(self.blob, np.uint8) == 32)
        begin, end = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(self.blob)]])
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = int(bounds[k]), int(bounds[k + 1])
            entries = slice(self.at[a], self.at[b])
            yield k, Lists(self.blob[begin[a] : end[b - 1]], self.sizes[a:b], self.docs[entries], self.counts[entries]).packed()


class Block:
    """The chunks of some documents, counted by portion: texts, or pieces of one, of about `PIECE_BYTES` together."""

    def __init__(self):
        self.groups, self.group_of, self.bytes = {}, [], 0
        self.names, self.parts = [], []
        self.waiting, self.waiting_bytes = [], 0

    def add(self, texts: pa.Array, sizes: list[int], groups: list[tuple[str, str]]) -> None:
        """Further documents: texts as bytes, their sizes and groups."""
        first, of = 0, len(self.group_of)
        for k, size in enumerate(sizes):
            if size > PIECE_BYTES:
                self._wait(texts, first, k, of)
                for piece in pieces(texts[k].as_py()):
                    self.waiting.append((pa.array([piece], pa.binary()), of + k))
                    self._count()
                first = k + 1
            else:
                self.waiting_bytes += size
                if self.waiting_bytes >= PIECE_BYTES:
                    self._wait(texts, first, k + 1, of)
                    self._count()
                    first = k + 1
        self._wait(texts, first, len(sizes), of)
        self._count()
        self.bytes += sum(sizes)
        self.group_of += [self.groups.setdefault(g, len(self.groups)) for g in groups]

    def _wait(self, texts: pa.Array, first: int, after: int, of: int) -> None:
        if after > first:
            self.waiting.append((texts.slice(first, after - first), of + first))

    def _count(self) -> None:
        """The distinct chunks of what waits, and each with its documents and counts."""
        if self.waiting:
            words, of_text = words_of(pa.concat_arrays([t for t, _ in self.waiting]))
            coded, docs = words.dictionary_encode(), np.concatenate([np.arange(d, d + len(t)) for t, d in self.waiting])
            key = np.sort(coded.indices.to_numpy().astype(np.int64) * BLOCK_DOCS + docs[of_text])
            first = _firsts(key)
            key, counts = key[first], np.diff(np.append(first, len(key))).astype(np.uint32)
            self.names.append(coded.dictionary)
            self.parts.append(((key // BLOCK_DOCS).astype(np.uint32), (key % BLOCK_DOCS).astype(np.uint16), counts))
        self.waiting, self.waiting_bytes = [], 0

    def full(self) -> bool:
        return self.bytes >= BLOCK_BYTES or len(self.group_of) >= BLOCK_DOCS

    def lists(self) -> Lists:
        """The chunks in the order of their hashes with their documents and counts.

        Documents are numbered by group; a count beyond 16 bits takes several entries.
        """
        group_of = np.array(self.group_of)
        number = np.empty(len(group_of), np.int64)
        number[np.argsort(group_of, kind="stable")] = np.arange(len(group_of))
        portions = np.cumsum([0, *(len(n) for n in self.names)])
        distinct, code = _numbered(self.names)
        by_hash = np.argsort(_hashes(distinct), kind="stable")
        place = np.empty(len(distinct), np.int64)
        place[by_hash] = np.arange(len(distinct))
        place = place[code]
        key = np.concatenate([np.zeros(0, np.int64), *(place[at + p[0]] * BLOCK_DOCS + number[p[1]] for at, p in zip(portions, self.parts))])
        count = np.concatenate([np.zeros(0, np.uint32), *(p[2] for p in self.parts)])
        self.parts, self.names = [], []
        order = np.argsort(key)
        key, count = key[order], count[order]
        chunk, doc = key // BLOCK_DOCS, key % BLOCK_DOCS
        times = (count + np.uint32(MOST - 1)) // np.uint32(MOST)
        counts = np.full(int(times.sum()), MOST, np.uint16)
        counts[np.cumsum(times) - 1] = count - (times - np.uint32(1)) * np.uint32(MOST)
        sizes = np.bincount(np.repeat(chunk, times), minlength=len(distinct))
        entries = np.repeat(doc, times).astype(np.uint16), counts
        return Lists(_blob(distinct.take(pa.array(by_hash))), sizes.astype(np.uint32), *entries)

    def ends(self) -> list[dict]:
        """The groups in the order of their documents' numbers, and the number after each one's last."""
        sizes = np.cumsum(np.bincount(self.group_of))
        return [{"lang": l, "source": s, "upto": int(n)} for (l, s), n in zip(self.groups, sizes)]


ENDS = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string()), ("upto", pa.int32())]))
BLOCK_SCHEMA = """block long, n_chunks long, names binary, sizes binary, docs binary, counts binary,
    ends array<struct<lang: string, source: string, upto: int>>"""


def _block_row(block: Block, number: int) -> pa.RecordBatch:
    lists = block.lists()
    columns = {"block": pa.array([number]), "n_chunks": pa.array([len(lists.sizes)])}
    columns |= {name: pa.array([cell], pa.binary()) for name, cell in lists.packed().items()}
    return pa.RecordBatch.from_pydict({**columns, "ends": pa.array([block.ends()], ENDS)})


def count_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made, block = TaskContext.get().partitionId(), 0, Block()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        sizes = pc.binary_length(texts).to_pylist()
        groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        first = 0
        while first < len(sizes):
            after, held = first, block.bytes
            while after < len(sizes) and held < BLOCK_BYTES and len(block.group_of) + after - first < BLOCK_DOCS:
                held += sizes[after]
                after += 1
            block.add(texts.slice(first, after - first), sizes[first:after], groups[first:after])
            first = after
            if block.full():
                yield _block_row(block, task << 32 | made)
                made, block = made + 1, Block()
    if block.group_of:
        yield _block_row(block, task << 32 | made)


PACKED = "names binary, sizes binary, docs binary, counts binary"
PACKED_FIELDS = [pa.field(c, pa.binary()) for c in ("names", "sizes", "docs", "counts")]


DEALT = pa.schema([pa.field(c, pa.int64()) for c in ("bucket", "block", "stripe")] + PACKED_FIELDS)
CUT = pa.schema(
    [pa.field(c, pa.int64()) for c in ("slice", "stripe")] + [pa.field(c, pa.binary()) for c in ("blocks", "have")] + PACKED_FIELDS
)


def deal(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The lists of every block cut into buckets by the chunks' hashes, in whose order they are."""
    for batch in batches:
        for row in batch.to_pylist():
            lists = Lists.unpacked(row)
            bucket = _hashes(lists.names()) * buckets >> 32
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            out = [{"bucket": k, "block": row["block"], "stripe": row["stripe"], **cells} for k, cells in lists.cut(bounds)]
            yield from pa.Table.from_pylist(out, DEALT).to_batches(max_chunksize=1000)


def terms_in(chunks: bytes) -> tuple[pa.Array, np.ndarray]:
    """The terms of chunks joined by spaces, and the number of the chunk of each."""
    told = np.frombuffer(chunks.translate(TERM_BYTES), np.uint8)
    inside = told != 32
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    spaces = np.flatnonzero(np.frombuffer(chunks, np.uint8) == 32)
    return words_of(pa.array([told.tobytes()], pa.binary()))[0], np.searchsorted(spaces, starts)


def cut_chunks(rows: pa.Table) -> pa.Table:
    """The lists of a bucket's chunks under the names of their terms; each distinct chunk is cut once.

    A row holds the terms of one slice in all blocks of one stripe, and how many names each block has.
    """
    rows = rows.to_pylist()
    every = [Lists.unpacked(row) for row in rows]
    chunks, ids = _numbered([lists.names() for lists in every])
    terms, of_chunk = terms_in(_blob(chunks))
    named, flat = _numbered([terms])
    many_of = np.bincount(of_chunk, minlength=len(chunks))
    starts = np.cumsum(many_of) - many_of
    of_slice = _hashes(named) % SLICES
    # By slice: names, and how many each block has; and their entries.
    parts: dict[tuple[int, int], list] = {}
    done = 0
    for row, lists in zip(rows, every):
        mine = ids[done : done + len(lists.sizes)]
        done += len(mine)
        many = many_of[mine]
        term, chunk_row = flat[_entries_of(starts[mine], many)], np.repeat(np.arange(len(mine)), many)
        order = np.argsort(of_slice[term], kind="stable")
        term, chunk_row = term[order], chunk_row[order]
        sizes = lists.sizes[chunk_row]
        at = _entries_of(lists.at[chunk_row], sizes.astype(np.int64))
        docs, counts = lists.docs[at], lists.counts[at]
        bounds = np.searchsorted(of_slice[term], np.arange(SLICES + 1))
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[bounds]
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = slice(bounds[k], bounds[k + 1]), slice(ends[k], ends[k + 1])
            parts.setdefault((k, row["stripe"]), []).append((row["block"], term[a], sizes[a], docs[b], counts[b]))
    out = []
    for (k, stripe), held in parts.items():
        blocks, term, *cells = zip(*held)
        lists = Lists(_blob(named.take(pa.array(np.concatenate(term)))), *(np.concatenate(c) for c in cells))
        have = {"blocks": np.array(blocks, np.int64).tobytes(), "have": np.array([len(t) for t in term], np.uint32).tobytes()}
        out.append({"slice": k, "stripe": stripe, **have, **lists.packed()})
    return pa.Table.from_pylist(out, CUT)


def unite(rows: pa.Table) -> pa.Table:
    """Of the terms of one slice in several blocks: documents, and occurrences by source, for each language."""
    groups, blocks, parts, upto, of_end = {}, {}, [], [], []
    for row in rows.to_pylist():
        if row["ends"] is not None:
            number = blocks.setdefault(row["block"], len(blocks))
            of_end += [groups.setdefault((e["lang"], e["source"]), len(groups)) for e in row["ends"]]
            upto += [number * BLOCK_DOCS + e["upto"] for e in row["ends"]]
        else:
            parts.append((Lists.unpacked(row), np.frombuffer(row["blocks"], np.int64), np.frombuffer(row["have"], np.uint32)))
    if not parts:
        return UNITED.empty_table()
    terms, code = _numbered([lists.names() for lists, _, _ in parts])
    upto, of_end = np.array(upto, np.int64), np.array(of_end, np.int64)
    key, done = [], 0
    for lists, of_block, have in parts:
        number = np.repeat(np.array([blocks[b] for b in of_block.tolist()], np.int64), have)
        name = code[done : done + len(number)]
        done += len(number)
        key.append(np.repeat((name * len(blocks) + number) * BLOCK_DOCS, lists.sizes) + lists.docs)
    key = np.concatenate(key)
    order = np.argsort(key)
    key, count = key[order], np.concatenate([lists.counts for lists, _, _ in parts]).astype(np.int64)[order]
    first = _firsts(key)
    key, count = key[first], np.add.reduceat(count, first)
    term = key // (BLOCK_DOCS * len(blocks))
    group = of_end[np.searchsorted(upto, key % (BLOCK_DOCS * len(blocks)), side="right")]
    named = sorted(groups)
    place = np.empty(len(named), np.int64)
    place[[groups[g] for g in named]] = np.arange(len(named))
    key = term * len(named) + place[group]
    order = np.argsort(key)
    key, count = key[order], count[order]
    first = _firsts(key)
    docs, count, key = np.diff(np.append(first, len(key))), np.add.reduceat(count, first), key[first]
    # The groups of a language follow one another, so its rows of a term do too.
    langs = sorted({g[0] for g in named})
    lang_of = np.array([langs.index(g[0]) for g in named])
    term, group = key // len(named), key % len(named)
    first = _firsts(term * len(langs) + lang_of[group])
    pairs = pa.StructArray.from_arrays(
        [pa.array([g[1] for g in named], pa.string()).take(pa.array(group)), pa.array(count)], names=["source", "n"]
    )
    texts = [t.decode("utf-8", "replace") for t in _bytes_of(terms)] if not _sound(terms) else terms
    columns = [
        pa.array(langs, pa.string()).take(pa.array(lang_of[group[first]])), pa.array(texts, pa.string()).take(pa.array(term[first])),
        pa.array(np.add.reduceat(docs, first)), pa.array(np.add.reduceat(count, first)), pa.ListArray.from_arrays(pa.array(np.append(first, len(key)), pa.int32()), pairs),
    ]
    return pa.Table.from_arrays(columns, schema=UNITED)


UNITED = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("n_docs", pa.int64()), ("n", pa.int64()),
    ("counts", pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))),
])


def _sound(names: pa.Array) -> bool:
    """Whether all are UTF-8."""
    try:
        names.validate(full=True)
    except pa.ArrowInvalid:
        return False
    return True


def _firsts(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def named(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).alias(column)


def kept_counts(
    docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """lang, source, term and n (occurrences, above zero) for the terms in at least `min_docs` documents of their language.

    lang_n are the occurrences in the language, and `leads` holds in one row of each term of a language.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(text.alias("text"), named(lang_col).alias("lang"), named(source_col).alias("source"))
    # Written once: the numbers of blocks and documents must not change when a task runs again.
    blocks = materialise(rows.mapInArrow(count_blocks, BLOCK_SCHEMA), "blocks")
    size = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n_chunks"), F.lit(0)).alias("chunks")).first()
    buckets = max(LEAST_BUCKETS, size["chunks"] // BUCKET_CHUNKS)
    stripes = -(-size["blocks"] // STRIPE_BLOCKS) or 1
    blocks = blocks.withColumn("stripe", F.pmod(F.xxhash64("block"), F.lit(stripes)))
    lists = blocks.where(F.col("n_chunks") > 0).drop("n_chunks", "ends")
    dealt = lists.mapInArrow(lambda batches: deal(batches, buckets), f"bucket long, block long, stripe long, {PACKED}")
    cut = dealt.groupBy("bucket").applyInArrow(cut_chunks, f"slice long, stripe long, blocks binary, have binary, {PACKED}")
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))).alias("slice")
    heads = blocks.select("block", slices, "stripe", "ends")
    united = cut.unionByName(heads, allowMissingColumns=True).groupBy("slice", "stripe").applyInArrow(
        unite, "lang string, term string, n_docs long, n long, counts array<struct<source: string, n: long>>"
    )
    # The rows of a term, one for each stripe, meet once; the sources of a row are in order.
    term = Window.partitionBy("lang", "term")
    whole = united.select(
        "lang", "term", "counts", F.sum("n_docs").over(term).alias("docs"), F.sum("n").over(term).alias("lang_n"),
        F.min(F.col("counts")[0]["source"]).over(term).alias("lead"),
    )
    kept = whole.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n", "lead", F.inline("counts"))
    leads = F.max(F.col("source") == F.col("lead")).alias("leads")
    return kept.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.max("lang_n").alias("lang_n"), leads)


def share(n: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count in billionths; null where a language keeps no term."""
    whole = total + terms * 2
    # Three digits at a time, so that nothing overflows: a count and its 2 are at most the whole.
    out, rest = F.lit(0).cast("long"), n + F.lit(2).cast("long")
    for _ in range(3):
        out, rest = out * 1000 + _quotient(rest * 1000, whole), rest * 1000 % whole
    return F.when(whole > 0, out + 1)


def _quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def difference(p: Column, q: Column) -> Column:
    return _quotient((p - q) * (p - q), p + q)


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: the other sources by divergence, and the most telling terms."""
    here = contextvars.copy_context()
    with scratch_scope(docs.sparkSession):  # the blocks go as soon as the counts are written, outside of the scope
        kept = here.run(materialise, kept_counts(docs, min_docs, text_col, lang_col, source_col), "kept")
    leads = F.col("leads").cast("long")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"), F.sum(leads).alias("led"))
    totals = materialise(totals, "totals")
    sizes = totals.groupBy("lang").agg(F.sum("led").alias("v"), F.sum("total").alias("lang_total"))
    occurring = docs.select(named(lang_col).alias("lang"), named(source_col).alias("source")).distinct()
    groups = occurring.join(totals.drop("led"), ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0)
    groups = materialise(groups.withColumn("p0", share(F.lit(0), F.col("total"), F.col("v"))), "groups")

    shared = kept.join(groups, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("v")).alias("p")
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")
    shares = materialise(shared.select("lang", "source", "term", "p0", p, q), "shares")

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        shares.where(F.col("p") > F.col("q"))
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top_terms)
    )
    pairs = _pair_sums(groups, shares).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return terms.unionByName(pairs.withColumn("rank", F.row_number().over(ranked)))


def _pair_sums(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """lang, source, item, value: the sum of differences over all kept terms for each two sources.

    With a's terms A and b's terms B, and shares a0 and b0 of terms that do not occur there:
    sum over A of d(a, b0) + sum over B of d(a0, b) + (V - |A| - |B|) * d(a0, b0)
    + sum over both of (d(a, b) - d(a, b0) - d(a0, b) + d(a0, b0)).
    """
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("held").alias("other_held"))
    pairs = groups.join(other, "lang").where(F.col("source") != F.col("item"))
    # Terms of one source with the same share count together.
    alike = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    alone = (
        alike.join(other.select("lang", "item", "q0"), "lang")
        .where(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("k") * difference(F.col("p"), F.col("q0"))).alias("alone"))
    )
    right = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("pb"), F.col("p0").alias("b0"))
    left = shares.select("lang", "term", "source", F.col("p").alias("pa"), F.col("p0").alias("a0"))
    pa_, pb, a0, b0 = (F.col(c) for c in ("pa", "pb", "a0", "b0"))
    both = (
        left.join(right, ["lang", "term"])
        .where(F.col("source") < F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(difference(pa_, pb) - difference(pa_, b0) - difference(a0, pb) + difference(a0, b0)).alias("both"))
    )
    swapped = ["lang", F.col("item").alias("source"), F.col("source").alias("item")]
    both = both.unionByName(both.select(*swapped, "both"))
    facing = alone.select(*swapped, F.col("alone").alias("facing"))
    keys = ["lang", "source", "item"]
    joined = pairs.join(alone, keys, "left").join(facing, keys, "left").join(both, keys, "left")
    rest = (F.col("v") - F.col("held") - F.col("other_held")) * difference(F.col("p0"), F.col("q0"))
    value = F.lit(0).cast("long")
    for part in (F.col("alone"), F.col("facing"), F.col("both"), rest):
        value = value + F.coalesce(part, F.lit(0))
    return joined.select(*keys, value.alias("value"))
