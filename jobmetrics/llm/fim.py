"""Fill-in-the-middle: a text is cut into prefix, middle and suffix, which trade places.

The cuts lie between units: code points, words (a word and the blanks after it) or lines. Where a
unit starts depends on the class of a character and of the one before it, so these pairs of classes
are the symbols of a wavelet matrix. The number of units that start before a position is a sum of
ranks, and the position of the k-th unit is found by bisection on that sum. One matrix holds the
texts of many documents, and all their cuts are found together.

Where to cut, and which form the output has, follow from a hash of the document's id, so every run
gives the same. Null texts count as empty. Empty texts, and texts that hold a marker, stay plain. A
null id hashes like an empty one. Repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

MARKERS = ("<P>", "<S>", "<M>")
# Characters whose texts share a matrix; a longer text has one of its own.
MATRIX_CHARS = 4_000_000

# Classes of characters, and the pairs (class before, own class) with which a unit starts.
LINE_BREAK, BLANK, WORD_CHAR, OTHER = range(4)
STARTS = {
    "code_point": [(a, b) for a in range(4) for b in range(4)],
    "word": [(a, b) for a in (LINE_BREAK, BLANK) for b in (WORD_CHAR, OTHER)],
    "line": [(LINE_BREAK, b) for b in range(4)],
}

_classes: np.ndarray | None = None


def character_classes() -> np.ndarray:
    """The class of every code point; made once in a Python worker."""
    global _classes
    if _classes is None:
        every = "".join(map(chr, range(0x110000)))
        table = np.full(len(every), OTHER, np.uint8)
        for pattern, kind in ((r"\w+", WORD_CHAR), (r"\s+", BLANK), (r"\n", LINE_BREAK)):
            for m in re.finditer(pattern, every):
                table[m.start() : m.end()] = kind
        _classes = table
    return _classes


class WaveletMatrix:
    """Ranks of symbols of a few bits in a sequence, from one bit vector for each bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.words, self.before, self.zeros = [], [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(symbols) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            counts = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.words.append(words)
            self.before.append(np.concatenate([[0], counts[:-1]]))
            self.zeros.append(len(symbols) - int(counts[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _ones(self, level: int, position: np.ndarray) -> np.ndarray:
        """How many bits of a level are set before a position."""
        word, inside = position >> 6, (position & 63).astype(np.uint64)
        part = self.words[level][word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(part)

    def rank(self, symbols: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position; one row a symbol."""
        low = np.zeros((len(symbols), 1), np.int64)
        high = np.broadcast_to(position, (len(symbols), len(position)))
        for level in range(self.bits):
            one = ((symbols >> (self.bits - 1 - level)) & 1)[:, None] == 1
            low_ones, high_ones = self._ones(level, low), self._ones(level, high)
            low = np.where(one, self.zeros[level] + low_ones, low - low_ones)
            high = np.where(one, self.zeros[level] + high_ones, high - high_ones)
        return high - low


class UnitIndex:
    """Where the units of several texts start."""

    def __init__(self, texts: list[str], unit: str):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.first, self.last = np.concatenate([[0], ends[:-1]]).astype(np.int64), ends
        own = character_classes()[points]
        previous = np.concatenate([[LINE_BREAK], own[:-1]]).astype(np.uint8)[: len(own)]
        self.matrix = WaveletMatrix(4 * previous + own, 4)
        self.symbols = np.array([4 * a + b for a, b in STARTS[unit]])
        # The first character of a text starts a unit whatever stands before it.
        self.skipped = self._starts(np.minimum(self.first + 1, self.last))

    def _starts(self, position: np.ndarray) -> np.ndarray:
        return self.matrix.rank(self.symbols, position).sum(0)

    def units_before(self, position: np.ndarray) -> np.ndarray:
        """Units of each text that start before a position in it."""
        return np.where(position > self.first, 1 + self._starts(position) - self.skipped, 0)

    def counts(self) -> np.ndarray:
        return self.units_before(self.last)

    def cut_after(self, units: np.ndarray) -> np.ndarray:
        """The character of each text with which the unit after so many units starts; its length after all."""
        low, high = self.first.copy(), self.last.copy()
        while (open_ := low < high).any():
            middle = (low + high) // 2
            reached = self.units_before(np.minimum(middle + 1, self.last)) > units
            high = np.where(open_ & reached, middle, high)
            low = np.where(open_ & ~reached, middle + 1, low)
        return low - self.first


def runs_of_texts(texts: list[str], chars: int = MATRIX_CHARS) -> list[slice]:
    """Neighbouring texts of at most so many characters together; a longer one stands alone."""
    runs, start, size = [], 0, 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > chars:
            runs.append(slice(start, k))
            start, size = k, 0
        size += len(text)
    return [*runs, slice(start, len(texts))] if texts else runs


def find_cuts(texts: list[str], a: np.ndarray, b: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the number n of units and the characters at which prefix and middle end.

    These are the smaller and the larger of a % (n + 1) and b % (n + 1) units.
    """
    out = [np.zeros(len(texts), np.int64) for _ in range(3)]
    for run in runs_of_texts(texts):
        index = UnitIndex(texts[run], unit)
        n = index.counts()
        x, y = a[run] % (n + 1), b[run] % (n + 1)
        for column, values in zip(out, (n, index.cut_after(np.minimum(x, y)), index.cut_after(np.maximum(x, y)))):
            column[run] = values
    return out[0], out[1], out[2]


def _cuts_udf(unit: str):
    def cuts(text: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        numbers = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (a, b))
        found = find_cuts(text.to_pylist(), *numbers, unit)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], names=["n", "prefix_end", "middle_end"])

    cuts.__annotations__ = {"text": pa.Array, "a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(cuts, "n long, prefix_end long, middle_end long")


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be found in one way only, also where one follows another or a text without markers."""
    if len(set(markers)) < 3 or not all(markers):
        raise ValueError("the markers must be three different strings that are not empty")
    for x in markers:
        for y in markers:
            overlap = any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)))) or (x != y and x in y)
            if overlap:
                raise ValueError(f"the markers {x!r} and {y!r} overlap")


def fill_in_middle(
    docs: DataFrame, unit: str = "code_point", id_col: str = "doc_id", text_col: str = "text",
    markers: tuple[str, str, str] = MARKERS, salt: str = "1:", plain_percent: int = 10, spm_percent: int = 20,
) -> DataFrame:
    """The id, n (units), form, prefix_chars, middle_chars (null if plain), output and text of every document."""
    check_markers(markers)
    if unit not in STARTS:
        raise ValueError(f"unit must be one of {sorted(STARTS)}")
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(key, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *numbers)
    cut = rows.withColumn("cut", _cuts_udf(unit)("text", "h1", "h2"))
    holds_marker = F.lit(False)
    for marker in markers:
        holds_marker = holds_marker | F.contains("text", F.lit(marker))
    form = (
        F.when((F.col("text") == "") | holds_marker | (F.col("h3") % 100 >= 100 - plain_percent), "plain")
        .when(F.col("h4") % 100 < spm_percent, "spm")
        .otherwise("psm")
    )
    shaped = cut.select("id", "text", form.alias("form"), "cut.n", "cut.prefix_end", "cut.middle_end")
    middle_chars = F.col("middle_end") - F.col("prefix_end")
    prefix = F.substring("text", F.lit(1), F.col("prefix_end").cast("int"))
    middle = F.substring("text", (F.col("prefix_end") + 1).cast("int"), middle_chars.cast("int"))
    suffix = F.substring("text", (F.col("middle_end") + 1).cast("int"), F.lit(2**31 - 1))
    p, s, m = (F.lit(x) for x in markers)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(F.col("text"))
    )
    moved = F.col("form") != "plain"
    return shaped.select(
        F.col("id").alias(id_col), "n", "form", F.when(moved, F.col("prefix_end")).alias("prefix_chars"),
        F.when(moved, middle_chars).alias("middle_chars"), output.alias("output"), F.col("text").alias(text_col),
    )


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that `output` was made from; in the forms with markers each marker stands once."""
    p, s, m = markers

    def part(start: str, end: str | None) -> Column:
        begin = F.instr(output, start) + len(start)
        length = F.instr(output, end) - begin if end else F.lit(2**31 - 1)
        return F.substring(output, begin, length)

    psm = F.concat(part(p, s), part(m, None), part(s, m))
    spm = F.concat(part(p, m), part(m, None), part(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
