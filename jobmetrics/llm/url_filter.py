"""URL filter: a trie over reversed host labels and path segments, longest match first.

A rule is written `host/path`. It fits its host and every subdomain if the URL's path starts with
the rule's path (which begins with the slash). The longest rule that fits decides; between equally
long ones the longer host does, then `block`. A URL that no rule fits gets the default verdict.

Nulls, empty strings and URLs without `://` have an empty host and path, which no rule fits.
Repeated rows are judged each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import insort

import pyarrow as pa
from pyspark.sql import DataFrame

from jobmetrics.llm.common import map_batches

# The list is broadcast with the task, so its size is checked: a million rules of 100 bytes each.
MAX_RULES = 1_000_000
MAX_RULE_BYTES = 100_000_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without `://`."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    for end in "?#":
        rest = rest.split(end, 1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


class RuleTrie:
    """Nodes are dicts. Host labels come first, last label first, then whole path segments.

    The last segment of a rule's path may be cut anywhere in a segment of the URL, so it is not a
    node: a node has its rules by that rest (`tails`), with the lengths that occur. A segment is
    looked up once for each length, however many rules there are.
    """

    def __init__(self, rules: list[tuple[str, str]]):
        self.root: dict = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            if not slash or not host:
                raise ValueError(f"a rule is host/path: {rule!r}")
            node = self.root
            for label in reversed(host.translate(_LOWER).split(".")):
                node = node.setdefault("labels", {}).setdefault(label, {})
            *segments, tail = path.split("/")
            for segment in segments:
                node = node.setdefault("segments", {}).setdefault(segment, {})
            tails = node.setdefault("tails", {})
            # Of rules that differ in verdict or letter case of the host only, a blocking one counts, then the first.
            if tail not in tails or (verdict == "block" and tails[tail][0] != "block"):
                tails[tail] = (verdict, rule)
            lengths = node.setdefault("lengths", [])
            if len(tail) not in lengths:
                insort(lengths, len(tail))

    def match(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, found = (-1, -1), (None, None)
        if not path.startswith("/"):
            return found
        segments = path[1:].split("/")
        node = self.root
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.get("labels", {}).get(label)
            if node is None:
                break
            below = node
            for segment in segments:
                for length in below.get("lengths", ()):
                    if length > len(segment):
                        break
                    verdict, rule = below["tails"].get(segment[:length], (None, None))
                    if rule is not None and (len(rule), depth) > best:
                        best, found = (len(rule), depth), (rule, verdict)
                below = below.get("segments", {}).get(segment)
                if below is None:
                    break
        return found


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], default: str = "allow", id_col: str = "page_id", url_col: str = "url",
    max_rules: int = MAX_RULES, max_rule_bytes: int = MAX_RULE_BYTES,
) -> DataFrame:
    """`id_col`, host, path, rule (null where none fits) and verdict of every row of `pages`.

    The trie is built once and broadcast, so a list longer than the given bounds is an error.
    """
    if len(rules) > max_rules or sum(len(r) for _, r in rules) > max_rule_bytes:
        raise ValueError("the rule list is too long to be broadcast")
    handle = pages.sparkSession.sparkContext.broadcast(RuleTrie(rules))
    kind = dict(pages.dtypes)[id_col]

    def make():
        trie = handle.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = [split_url(u) for u in batch.column(url_col).to_pylist()]
            found = [trie.match(h, p) for h, p in parts]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([r for r, _ in found], pa.string()),
                    pa.array([v or default for _, v in found], pa.string()),
                ],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

        return step

    return map_batches(
        pages.select(id_col, url_col), make, f"{id_col} {kind}, host string, path string, rule string, verdict string"
    )
