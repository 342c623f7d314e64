"""Personal data: plain identifiers, and disguised ones found in a normalised text.

Plain e-mail addresses, IPv4 addresses, card and phone numbers are found in the text as it is.
Disguised ones are found by transducers that rewrite homoglyphs, spelled digits and at/dot
disguises, and that note for every character written which source characters it stands for; what
is found in the rewritten text is mapped back to a span of the source. Plain spans are never
changed; a disguised one is added where it overlaps no span found before.

All positions are code points of the source text, ends exclusive. Null and empty texts have no
spans. Rows are independent of each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame

from jobmetrics.llm.common import map_batches, texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # number of the kind, start, end

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str):
    """Matches of the address pattern; from each @ to the left and right, so no run is read twice."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text: str) -> list[Span]:
    found: list[Span] = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m.group()))
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                found.append((3, *m.span()))
    return found


# Letters of other scripts that look like ASCII ones.
_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ⅼ": "l",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".", "｡": ".", "·": ".", " ": " ",
}
_INVISIBLE = frozenset("­​‌‍⁠﻿")
# Number words.
_NUMBER_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "oh": "0",
}
_ODD = re.compile(r"[^\x00-\x7FÀ-ÿ]|[ ­·]")
_NUMBER = re.compile(r"(?i)(?<![A-Za-z])(?:" + "|".join(_NUMBER_WORDS) + r")(?![A-Za-z])")
# A bracketed "at", or a bare one that is followed by a spelled dot. No pattern starts inside a run of blanks:
# one that did would read the rest of the run from each of them. Blanks before a bracket are added to the match.
_AT = re.compile(
    r"(?i)[\[({<]\s*at\s*[\])}>]\s*|(?<=[A-Za-z0-9])\s+at\s+(?=[A-Za-z0-9-]+(?:\s*[\[({<]\s*dot\s*[\])}>]|\s+dot\s)\s*[A-Za-z0-9])"
)
_DOT = re.compile(r"(?i)[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|(?<=[A-Za-z0-9])\s+(?:dot|point)\s+(?=[A-Za-z0-9])")
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])\s+@\s*(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@\s+(?=[A-Za-z0-9-]+\.[A-Za-z0-9])")
_PLUS = re.compile(r"(?i)(?<![A-Za-z])plus\s+(?=[0-9])")
_SIGNS = ((_AT, "@"), (_DOT, "."), (_SPACED_AT, "@"), (_PLUS, "+"))
# So many number words in a run are rewritten wherever they stand, fewer where they touch digits or a plus sign.
_LEAST_NUMBERS = 4
_DIGITS_BEFORE = re.compile(r"(?i)(?:[0-9][\s.,()\-]{0,3}(?:\b(?:dot|point)\s{1,3})?|\+[\s(]{0,3}|\bplus\s{1,3})\Z")
_DIGITS_AFTER = re.compile(r"(?i)[\s.,()\-]{0,3}(?:\b(?:dot|point)\s{1,3})?[0-9]")


class Tape:
    """A rewritten text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.starts = list(range(len(text)))
        self.ends = list(range(1, len(text) + 1))

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) by a string each; `changes` are in order and do not overlap.

        Every character of a replacement stands for all the source characters it replaces.
        """
        if not changes:
            return
        text, starts, ends, at = [], [], [], 0
        for start, end, new in changes:
            text.append(self.text[at:start])
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            text.append(new)
            starts += [self.starts[start]] * len(new)
            ends += [self.ends[end - 1]] * len(new)
            at = end
        text.append(self.text[at:])
        self.starts, self.ends = starts + self.starts[at:], ends + self.ends[at:]
        self.text = "".join(text)

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]


def _plain_character(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded != c and folded.isascii() and folded.isprintable() else c


def _glyphs(tape: Tape) -> None:
    found = [(m.start(), m.end(), _plain_character(m.group())) for m in _ODD.finditer(tape.text)]
    tape.rewrite([x for x in found if x[2] != tape.text[x[0] : x[1]]])


def _touches_digits(text: str, run: list[re.Match]) -> bool:
    """Whether digits, or a plus sign in front, stand beside a run of number words or within it."""
    start, end = run[0].start(), run[-1].end()
    return bool(
        _DIGITS_BEFORE.search(text, max(0, start - 16), start)
        or _DIGITS_AFTER.match(text, end)
        or _DIGIT.search(text, start, end)
    )


def _numbers(tape: Tape) -> None:
    """Number words become digits, where several follow each other or stand beside digits."""
    words = list(_NUMBER.finditer(tape.text))
    runs: list[list[re.Match]] = []
    for word in words:
        between = tape.text[runs[-1][-1].end() : word.start()] if runs else "x"
        if runs and len(between) <= 12 and re.fullmatch(r"[\s,.\-()0-9]*(?:\b(?:dot|point)\b[\s]*)?", between):
            runs[-1].append(word)
        else:
            runs.append([word])
    changes = []
    for run in runs:
        if len(run) < _LEAST_NUMBERS and not _touches_digits(tape.text, run):
            continue
        for k, word in enumerate(run):
            end = word.end()
            if k + 1 < len(run) and re.fullmatch(r"[\s,\-]+", tape.text[end : run[k + 1].start()]):
                end = run[k + 1].start()
            changes.append((word.start(), end, _NUMBER_WORDS[word.group().lower()]))
    tape.rewrite(changes)


def _signs(tape: Tape) -> None:
    for pattern, sign in _SIGNS:
        changes, end = [], 0
        for m in pattern.finditer(tape.text):
            start = m.start()
            if tape.text[start] in "[({<":
                while start > end and tape.text[start - 1].isspace():
                    start -= 1
            end = m.end()
            changes.append((start, end, sign))
        tape.rewrite(changes)


def _disguised(text: str) -> bool:
    """Whether any transducer rewrites the text; the first one that does finds its pattern in the text as it is."""
    if any(pattern.search(text) for pattern, _ in _SIGNS):
        return True
    if not text.isascii() and _ODD.search(text):
        return True
    words = sum(1 for _ in _NUMBER.finditer(text))
    return words >= _LEAST_NUMBERS or words > 0 and ("+" in text or _DIGIT.search(text) is not None)


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans; both by kind and start."""
    plain = sorted(plain_spans(text))
    if not _disguised(text):
        return plain, plain
    tape = Tape(text)
    _glyphs(tape)
    _numbers(tape)
    # Signs are rewritten on a second tape: a bare "dot" may also end a sentence before a number.
    found = {(kind, *tape.source(s, e)) for kind, s, e in plain_spans(tape.text)}
    _signs(tape)
    found |= {(kind, *tape.source(s, e)) for kind, s, e in plain_spans(tape.text)}
    everything, taken = list(plain), Taken((s, e) for _, s, e in plain)
    for kind, s, e in sorted(found - set(plain), key=lambda x: (x[1] - x[2], x)):
        if taken.add(s, e):
            everything.append((kind, s, e))
    return plain, sorted(everything)


class Taken:
    """Disjoint intervals, to which only what overlaps none is added."""

    def __init__(self, intervals: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(intervals):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)  # the intervals before this one start before the end
        if k and self.ends[k - 1] > start:
            return False
        self.starts.insert(k, start)
        self.ends.insert(k, end)
        return True


def written(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{s}:{e}" for kind, s, e in found)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of plain spans by kind, base_sha256 over the plain spans, and all spans."""
    kind = dict(docs.dtypes)["doc_id"]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [spans(t) for t in texts_of(batch)]
            counts = [[sum(k == i for k, _, _ in plain) for plain, _ in found] for i in range(len(KINDS))]
            hashes = [hashlib.sha256(written(plain).encode()).hexdigest() for plain, _ in found]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(hashes, pa.string()),
                    pa.array([written(every) for _, every in found], pa.string()),
                ],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

        return step

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_batches(
        docs.select("doc_id", "text"), make, f"doc_id {kind}, {counts}, base_sha256 string, spans string"
    )


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one mark."""
    out, at = [], 0
    for s, e, kind in sorted((s, e, kind) for kind, s, e in spans(text)[1]):
        if s >= at:
            out += [text[at:s], f"[{KINDS[kind].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with masked texts; null texts stay null."""
    schema = docs.schema

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if t is None else masked(t) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            return batch.set_column(at, "text", pa.array(texts, pa.string()))

        return step

    return map_batches(docs, make, schema)
