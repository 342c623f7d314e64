"""Fill-in-the-middle, source divergence and chat formatting against plain Python on small tables."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobmetrics.llm import chat, divergence, fim, pii, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n long, form string, p long, v long, term string, block long"
OTHERS = (5, "x", 6, 7, "y", 8)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *OTHERS) for r in rows], SCHEMA)


def units_of(text, unit):
    if unit == "code_point":
        return list(text)
    return re.findall(r"\n|[^\n]+\n?" if unit == "line" else r"\s+|\S+\s*", text) if text else []


TEXT = st.text(alphabet="ab1_ \n\t.é你😀<P>", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXT, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=6), st.sampled_from(sorted(fim.STARTS)))
def test_cuts_fall_between_units(rows, unit):
    texts = [r[0] for r in rows]
    a, b = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2))
    n, first, second = fim.find_cuts(texts, a, b, unit)
    for k, text in enumerate(texts):
        units = units_of(text, unit)
        x, y = sorted((a[k] % (len(units) + 1), b[k] % (len(units) + 1)))
        assert (n[k], first[k], second[k]) == (len(units), len("".join(units[:x])), len("".join(units[:y])))


def test_wavelet_ranks_and_runs():
    symbols = np.random.default_rng(1).integers(0, 16, 1000).astype(np.uint8)
    at = np.array([0, 1, 63, 64, 65, 500, 999, 1000])
    ranks = fim.WaveletMatrix(symbols, 4).rank(np.arange(16), at)
    assert ranks.tolist() == [[int((symbols[:p] == s).sum()) for p in at] for s in range(16)]
    assert fim.runs_of_texts(["a" * 3, "b" * 9, "", "c" * 2, "d"], 5) == [slice(0, 1), slice(1, 2), slice(2, 5)]
    assert fim.runs_of_texts([]) == []


def expected_fim(doc_id, text, markers=fim.MARKERS):
    text = text or ""
    key = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(key[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in markers) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}", text


def test_fill_in_middle(spark):
    rng = random.Random(3)
    texts = [None, "", "a", "ab<M>c", "<", "<P", "\n\n", "😀é" * 50, "x" * 300_000]
    texts += ["".join(rng.choice("ab <>PSM\n😀é") for _ in range(rng.randrange(200))) for _ in range(200)]
    rows = [*enumerate(texts, -3), (7, texts[9]), (7, texts[9]), (None, "no id")]
    done = fim.fill_in_middle(frame(spark, [(i, t, None, "s") for i, t in rows]))
    got = done.withColumn("again", fim.restored(F.col("output"), F.col("form"))).drop("text").collect()
    want = [expected_fim(i, t) for i, t in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame(spark, [])).count() == 0
    words = fim.fill_in_middle(frame(spark, [(k, "one two  three\nfour ", "", "") for k in range(60)]), unit="word", plain_percent=0)
    ends = {r.prefix_chars for r in words.collect()}
    assert ends <= {0, 4, 9, 15, 20} and len(ends) > 3
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "P", "<M>"), ("ab", "ba", "<M>"), ("", "b", "c")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(frame(spark, []), markers=bad)


def brute_divergence(rows, min_docs, top):
    docs = []
    for _, text, lang, source in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs.append((lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)))
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        holders = {}
        for k, (_, _, terms) in enumerate(mine):
            for t in terms:
                holders.setdefault(t, set()).add(k)
        kept = sorted(t for t, h in holders.items() if len(h) >= min_docs)
        def shares(terms):
            n = {t: terms.count(t) for t in kept}
            return n, {t: 1 + 10**9 * (n[t] + 2) // (sum(n.values()) + 2 * len(kept)) for t in kept}
        _, whole = shares([t for d in mine for t in d[2]])
        groups = {s: shares([t for d in mine if d[1] == s for t in d[2]]) for s in {d[1] for d in mine}}
        for s, (n, p) in groups.items():
            pairs = [(o, sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept)) for o, (_, q) in groups.items() if o != s]
            terms = [(t, (p[t] - whole[t]) ** 2 // (p[t] + whole[t])) for t in kept if n[t] and p[t] > whole[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["über", "Über", "a-b", "don't", "X,", "x", "(x)", "你好", "你　好", "12"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = []
    for k in range(n):
        text = rng.choice([" ", "\n", "\t "]).join(rng.choices(words, weights, k=rng.randrange(30)))
        rows.append((k, text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", "é", None])))
    return rows


@pytest.mark.parametrize("seed, min_docs", [(1, 10), (2, 2), (3, 1000)])
def test_source_divergence(spark, monkeypatch, seed, min_docs):
    rows = [*corpus(seed), (None, None, "en", "empty"), (0, "", "fr", "only"), (9, "x X x", "en", "a"), (9, "x X x", "en", "a"), (5, "1 2", "it", "u"), (5, "...", "it", "v")]
    monkeypatch.setattr(divergence, "STRIPE_BLOCKS", 2)  # several stripes
    got = divergence.source_divergence(frame(spark, rows).repartition(5), min_docs=min_docs).collect()
    assert sorted(map(tuple, got)) == brute_divergence(rows, min_docs, 10)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(frame(spark, [])).count() == 0
    assert divergence.source_divergence(frame(spark, [(1, None, None, None)])).count() == 0


def test_words_are_cut_as_bytes():
    texts = [b"", b" ", b"a  b\x0b\x0cc\r\n", b"\xc2\x85x\x1cy\x00 z", b"\xff \xfe\xff", "\u3000 \u00a0".encode(), b"\td"]
    words, of_text = divergence.words_of(pa.array(texts, pa.binary()).slice(1))
    want = [(k, w) for k, t in enumerate(texts[1:]) for w in t.split()]
    assert list(zip(of_text.tolist(), words.view(pa.binary()).to_pylist())) == want


def test_bucket_of_many_blocks():
    # A row of a bucket's result for each slice and stripe, not for each block.
    texts = [f"W{k % 7} (x) x,y-{k} ü".encode() for k in range(40)]
    rows = []
    for number in range(20):
        block = divergence.Block()
        two = texts[2 * number : 2 * number + 2]
        block.add(pa.array(two, pa.binary()), [len(t) for t in two], [("en", "a"), ("en", "b")])
        rows.append({"bucket": 0, "block": number, "stripe": 0, **block.lists().packed()})
    cut = divergence.cut_chunks(pa.Table.from_pylist(rows, divergence.DEALT))
    assert cut.num_rows <= divergence.SLICES
    found = Counter()
    for row in cut.to_pylist():
        lists = divergence.Lists.unpacked(row)
        blocks = np.repeat(np.frombuffer(row["blocks"], np.int64), np.frombuffer(row["have"], np.uint32))
        for k, (block, name) in enumerate(zip(blocks.tolist(), lists.names().to_pylist())):
            for at in range(lists.at[k], lists.at[k + 1]):
                found[2 * block + int(lists.docs[at]), name] += int(lists.counts[at])
    terms = Counter((k, w) for k, t in enumerate(texts) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.decode().lower()))
    assert found == terms


def test_blocks_of_long_texts(spark):
    text = b"aa bb\n" * 100_000 + b"c" * 3_000_000 + b" dd"
    assert b"".join(divergence.pieces(text, 1000)) == text and list(divergence.pieces(b"")) == [b""]
    rows = [(1, text.decode(), "en", "s"), (2, "aa", "en", "t")]
    counts = {(r.source, r.term): r.n for r in divergence.kept_counts(frame(spark, rows), 1).collect()}
    assert counts == {("s", "aa"): 100_000, ("s", "bb"): 100_000, ("s", "c" * 3_000_000): 1, ("s", "dd"): 1, ("t", "aa"): 1}
    assert {(r.source, r.term): r.n for r in divergence.kept_counts(frame(spark, rows), 2).collect()} == {("s", "aa"): 100_000, ("t", "aa"): 1}


CHAT = "conv_id long, turn long, role string, text string, id long, turns string, pieces int"


def chat_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CHAT)


def reread(spark, rows, **kw):
    done, template = chat.format_conversations(chat_frame(spark, rows), **kw), kw.get("template", chat.Template())
    learned = chat.masked_texts(F.col("formatted"), F.col("loss_spans"), template).alias("learned")
    out = done.select("*", chat.read_turns(F.col("formatted"), template).alias("turns"), learned)
    return {r.conv_id: r for r in out.collect()}


def test_conversations_are_read_back(spark):
    rng = random.Random(5)
    bits = ["### ", "<text>", "</turn>", "\\", "#", "\n", "<text", "a", "é😀", " ", "\n</turn>\n", "\n<text>\n"]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 9)):
            text = "".join(rng.choices(bits, k=rng.randrange(8)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "", "<text>", "a\\"]), text))
    rows += [(100, k, "assistant" if k % 3 else "user", f"t{k}") for k in range(2000)]
    rows += [(101, None, None, None), (None, 1, "user", None), (102, 0, "assistant", "b"), (102, 0, "assistant", "b"), (102, 0, "assistant", "a")]
    got = reread(spark, rows)
    want = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in got.items()} == want
    assert {k: r.learned for k, r in got.items()} == {k: [t for role, t in v if role == "assistant"] for k, v in want.items()}
    for k, r in got.items():
        cut = [r.formatted[s.start : s.end] for s in r.loss_spans]
        runs = 1 + sum(a[0] != b[0] for a, b in zip(want[k], want[k][1:]))
        assert r.formatted.count("\n</turn>\n") >= runs == len(re.findall(r"(?<!\\)### ", r.formatted))
        assert all(x.end <= y.start for x, y in zip(r.loss_spans, r.loss_spans[1:])) and len(cut) == len(r.learned)
    assert got[102].formatted == "### assistant\n<text>\na\n<text>\nb\n<text>\nb\n</turn>\n"
    assert reread(spark, []) == {}


def test_long_turns_and_templates(spark):
    long_ = "### é" * 200_000
    got = reread(spark, [(1, 0, "user", long_), (1, 1, "bot", long_ + "\\")], template=chat.Template(open="[a]", text="[b]", close="[c]", escape="%"), learned_roles=("bot",))
    assert [t.text for t in got[1].turns] == [long_, long_ + "\\"] and got[1].learned == [long_ + "\\"]
    for bad in ({"open": "<text"}, {"close": "### "[:2] + "x", "open": "x##"}, {"escape": "#"}, {"escape": ""}, {"text": ""}):
        with pytest.raises(ValueError):
            chat.Template(**bad)


def test_sums_before(spark):
    values = [list(range(n)) for n in (0, 1, 5, 127, 128, 129, 1000)]
    rows = spark.createDataFrame([(v,) for v in values], "v array<long>").select("v", chat.sums_before(F.col("v"), 7).alias("s")).collect()
    assert all(r.s == [sum(r.v[:k]) for k in range(len(r.v))] for r in rows)


@pytest.mark.parametrize("piece", [" ", "\n", "@", "+", "(", "1", "a", "a@", "a ", "( ", "+1 ", " at ", "dot ", "[at] ", "one ", "1.", "a at a ", "é", " (dot) "])
def test_personal_data_in_very_long_runs(piece):
    text = piece * (1_000_000 // len(piece))
    start = time.process_time()
    pii._disguised(text)
    assert time.process_time() - start < 3
    pii.spans("x" + text[:200_000] + "(at) b dot com")
    assert time.process_time() - start < 30


def test_spans_around_blanks():
    text = "mail jane" + " " * 5000 + "(at)" + "\n" * 5000 + "example [dot] com or bob  <at>  x (dot) org"
    found = [text[s:e] for _, s, e in pii.spans(text)[1]]
    assert found == [text[5 : text.index(" or")], "bob  <at>  x (dot) org"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 10)), max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 10)), max_size=12))
def test_taken_intervals(first, more):
    taken, covered = pii.Taken((s, s + n) for s, n in first), {k for s, n in first for k in range(s, s + n)}
    for s, n in more:
        free = not covered & set(range(s, s + n))
        assert taken.add(s, s + n) == free
        covered |= set(range(s, s + n)) if free else set()


HOSTS, PATHS = ["net", "a.net", "b.a.net", "A.Net"], ["", "x", "x/", "xy", "x/y", "/", "x/yz/", "é"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), st.sampled_from(HOSTS), st.sampled_from(PATHS)), max_size=8), st.sampled_from(HOSTS), st.sampled_from(PATHS))
def test_rule_trie(rules, host, path):
    rules, host, path = [(v, f"{h}/{p}") for v, h, p in rules], host.lower(), f"/{path}z"
    fits = []
    for k, (verdict, rule) in enumerate(rules):
        h, _, p = rule.partition("/")
        if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith("/" + p):
            fits.append((len(rule), h.count("."), verdict == "block", -k, rule, verdict))
    assert url_filter.RuleTrie(rules).match(host, path) == (max(fits)[-2:] if fits else (None, None))


def test_many_rules_of_one_host():
    few, many = (url_filter.RuleTrie([("block", f"example.com/p{k}") for k in range(n)]) for n in (100, 100_000))

    def seconds(trie):
        start = time.process_time()
        for k in range(20_000):
            trie.match("www.example.com", f"/q{k}/x")
        return time.process_time() - start

    assert seconds(many) < 10 * seconds(few)
    assert many.match("example.com", "/p99999/z") == ("example.com/p99999", "block")
