"""The operators against brute force on small tables with nulls, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import os
import random
import re
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from jobmetrics.llm import ann, bpe, jaccard, packing, pii, quality_model, quality_rules, substrings, toxicity, url_filter
from jobmetrics.llm.queries import PATTERN, RANKS, RULES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk int, label string, h binary"
OTHERS = ("en", "s", 1, 7, "x", b"y")


def frame(spark, texts, start=0):
    """Documents from texts or (id, text) pairs, with columns named like the operators' own."""
    rows = [(k, t) if not isinstance(t, tuple) else t for k, t in enumerate(texts, start)]
    return spark.createDataFrame([(i, t, *OTHERS) for i, t in rows], SCHEMA)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    shared, base = prose(1, 60), prose(2, 300).split(" ")
    near = [" ".join(base[:k] + ["zz"] + base[k + 1 :]) for k in (3, 90, 200)]
    far = [" ".join(w if (k + j) % 9 else f"q{j}" for j, w in enumerate(base)) for k in range(3)]
    mixed = [prose(10 + k, 40) + "\n" + shared + " \t" + prose(20 + k, 30) for k in range(4)]
    copies = [prose(5, 100)] * 4
    return [None, "", " \n", "a", "a b", "A B", "a b c", "A b C", *near, " ".join(base), *far, *mixed, *copies, shared, prose(9, 9000)]


def test_substring_dedup(spark, texts):
    docs = frame(spark, [*enumerate(texts), (len(texts) - 2, texts[-2]), (None, texts[-2])])
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substrings.remove_repeats(docs).collect()}
    words = [WORD.findall(t or "") for t in texts]
    first = {}
    for i, w in enumerate(words):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = {(None, 60, 0, texts[-2])}
    for i, w in enumerate(words):
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        want.add((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert got == want
    assert sum(n for _, _, n, _ in want) > 300


@pytest.mark.parametrize("length", [5, 13, 30])
def test_substring_levels(spark, texts, length):
    assert substrings.levels(13) == [7, 13] and substrings.levels(5) == [5]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(frame(spark, texts), length).collect()}
    first, want = {}, {}
    for i, t in enumerate(texts):
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - length + 1):
            if first.setdefault(tuple(w[k : k + length]), i) < i:
                gone |= set(range(k, k + length))
        want[i] = len(gone)
    assert got == want


def test_jaccard_components(spark, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 2)  # so that combinations and blocks are used on this table
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 4)
    docs = frame(spark, [*enumerate(texts), (None, texts[-2])])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_documents(docs).collect()}
    lower = {c: c + 32 for c in range(65, 91)}
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(lower))
        sets.append(set(zip(w, w[1:], w[2:])) if len(w) >= 3 else ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    assert {i: got[i] for i in range(len(sets))} == {i: (len(s), label[i]) for i, s in enumerate(sets)}
    assert got[None][1] is None


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_jaccard_settings(spark, texts, monkeypatch, words, percent):
    import corpus_pipeline

    assert (corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_SIMILARITY) == (5, 0.8)
    rng, near = random.Random(7), []
    for n in (40, 120, 300, 500, 1000):
        base = prose(n, n, 10**6).split(" ")
        near.append(" ".join(base))
        for part in (10, 18, 25, 45, 50, 55, 70):
            gone = set(rng.sample(range(n), max(1, n // part)))
            near.append(" ".join("new%d" % rng.randrange(10**6) if k in gone else w for k, w in enumerate(base)))
    lower = {c: c + 32 for c in range(65, 91)}
    every = [*texts, *near]
    sets = []
    for t in every:
        w = WORD.findall((t or "").translate(lower))
        sets.append(set(zip(*[w[k:] for k in range(words)])) if len(w) >= words else ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
    want = {i: (len(s), label[i]) for i, s in enumerate(sets)}
    for frequent in (32, 2):
        monkeypatch.setattr(jaccard, "FREQUENT", frequent)
        got = jaccard.similar_documents(frame(spark, every), words, percent / 100).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    if words == 5:
        kept = corpus_pipeline.jaccard_stage(spark, frame(spark, every), "").collect()
        assert {r.doc_id for r in kept} == {i for i, x in enumerate(label) if i == x}


def test_jaccard_two_texts_of_one_id(spark):
    """Each of the two has a document that links with it alone."""

    def changed(words, places, mark):
        return [f"{mark}{k}" if k in places else w for k, w in enumerate(words)]

    one = prose(3, 300, 10**6).split(" ")
    two = changed(one, {150}, "x")
    left, right = changed(one, {10, 30, 50, 70, 90}, "l"), changed(two, {210, 230, 250, 270, 290}, "r")
    sets = [set(zip(w, w[1:], w[2:])) for w in (one, two, left, right)]
    links = [[100 * len(a & b) >= 90 * len(a | b) for b in sets[2:]] for a in sets[:2]]
    assert links == [[True, False], [False, True]]
    firsts = [jaccard.Measure.of(3, 0.9).shingles(" ".join(w), jaccard.WordHashes())[0] for w in (one, two)]
    assert firsts[0] == firsts[1]
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join(left)), (3, " ".join(right))]
    got = {(r.doc_id, r.component_id) for r in jaccard.similar_documents(frame(spark, rows)).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


@pytest.mark.parametrize("words, threshold", [(3, 0.9), (5, 0.8), (5, 0.55)])
def test_jaccard_bounds(words, threshold):
    """Linked sets have a combination in common and pass the size and fingerprint filters."""
    measure, rng = jaccard.Measure.of(words, threshold), np.random.default_rng(3)
    for n in [*range(1, 40), 100, 333, 1000]:
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for m in {n, measure.largest_partner(n), (n + measure.largest_partner(n)) // 2}:
            d = max(0, int(measure.allowed_difference(n, m)))
            gone = (d - (m - n)) // 2
            t = np.unique(np.concatenate([s[gone:], rng.integers(0, 2**63, m - n + gone).astype(np.uint64)]))
            common = len(np.intersect1d(s, t))
            if not measure.links(common, len(s) + len(t) - common):
                continue
            shared = np.intersect1d(s, t)
            for often in (0.0, 0.3, 0.9, 1.0):  # how many of the shared tokens are frequent
                counts = np.where(rng.random(len(shared)) < often, rng.integers(33, 99, len(shared)), 2)
                told = dict(zip(shared.tolist(), counts.tolist()))
                told |= {h: 50 for h in np.setxor1d(s, t).tolist() if rng.random() < often}
                assert np.intersect1d(measure.keys(s, told), measure.keys(t, told)).size
            x, y = measure.fingerprint(s), measure.fingerprint(t)
            least = min(len(x), len(y))
            assert (jaccard.folded(x, least) != jaccard.folded(y, least)).sum() <= measure.allowed_difference(n, m)
            assert np.intersect1d(s[: measure.prefix(n)], t[: measure.prefix(m)]).size


def test_frequent_tokens_alone_link(monkeypatch):
    """Only pairs of frequent tokens are keys, and their number grows with the set, not with its square."""
    measure, rng = jaccard.Measure.of(3, 0.9), np.random.default_rng(5)
    for n in (300, 3_000, 30_000):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        t = s[np.sort(rng.permutation(n)[: n - n // 20])]
        told = dict.fromkeys(s.tolist(), 1000)
        mine, other = measure.keys(s, told), measure.keys(t, told)
        assert np.intersect1d(mine, other).size and not np.intersect1d(mine, s).size
        assert len(mine) < n
        rare = measure.keys(s, told | dict.fromkeys(s[s % measure.counted == 0].tolist(), 2))
        assert np.isin(rare, s).sum() >= min(measure.prefix(n), len(s[s % measure.counted == 0]))
        assert measure.classes(measure.bands(n)[0][1])[1] == jaccard.COMBINED == 2
    monkeypatch.setattr(jaccard, "COMBINED", 3)
    told = dict.fromkeys(s.tolist(), 1000)
    assert np.intersect1d(measure.keys(s, told), measure.keys(t, told)).size


def test_empty_tables(spark):
    none = frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert substrings.remove_repeats(none).count() == 0
    assert jaccard.similar_documents(none).count() == 0
    assert quality_rules.judge_documents(none).count() == 0
    assert pii.find_personal_data(none).count() == 0
    assert bpe.digests(none, RANKS, PATTERN).count() == 0
    assert packing.pack(packing.token_pieces(none, RANKS, PATTERN, 2)).count() == 0
    assert quality_model.score_quality(none, labels).count() == 0
    assert toxicity.score_toxicity(none, labels).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(vectors, vectors).count() == 0
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_packing(spark, texts):
    docs = frame(spark, [*texts, "x<|endoftext|>y", "x<|endoftext|>y"])
    rows = packing.pack(packing.token_pieces(docs, RANKS, PATTERN, 2, 256), 256, 8).collect()
    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {k: [*reference.encode(r.text or "", add_special_tokens=False).ids, 2] for k, r in enumerate(docs.collect())}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.length <= 256
    for doc, ids in want.items():
        pieces = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == ids
        assert all(r.length == 256 for r in pieces[1:])
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == list(np.cumsum([0, *[r.length for r in pieces[:-1]]]))
        assert sum(r.length for r in pieces) <= 256


def test_packing_of_a_small_table_together(spark):
    pieces = spark.createDataFrame([(k, 0, 300 + k % 7) for k in range(60)], "doc_id long, piece int, length long")
    rows = packing.pack(pieces, 1024).collect()
    assert len(rows) == 60 and len({r.sequence_id for r in rows}) == 20


def test_best_fit_takes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 3, 4, 9, 1)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (2, 9)]
    fit = packing.BestFit(10, 1)
    assert fit.place(5) == (0, 0) and fit.place(8) == (1, 0)  # sequence 1 is the fullest and closes
    assert fit.place(2) == (0, 5)


RANK_TABLE = bpe.load_ranks(RANKS)
ENCODER = bpe.TextEncoder(RANK_TABLE, PATTERN)
LIBRARY = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=RANK_TABLE, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text("ab '\n", max_size=300), st.text("théeaionw ", max_size=400)))
def test_bpe_like_the_library(text):
    ids = ENCODER.packed(text)
    assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
    assert ENCODER.unpacked(ids) == text.encode("utf-8", "replace")


def test_bpe_long_runs():
    rng = random.Random(3)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("etaoinshr") for _ in range(6000)), " " * 500, "=" * 999):
        assert np.frombuffer(ENCODER.packed(text), "<u4").tolist() == LIBRARY.encode_ordinary(text)


def test_bpe_merging_by_scan_and_by_heap(monkeypatch):
    rng, tree = random.Random(5), ENCODER.tree
    strings = ["".join(rng.choice("etaoin shré=1") for _ in range(rng.randint(1, 90))).encode() for _ in range(800)]
    by_length = [tree.merge(x) for x in strings]
    for limit in (0, 10**6):
        monkeypatch.setattr(bpe, "SCAN_BYTES", limit)
        assert [tree.merge(x) for x in strings] == by_length


def test_bpe_query(spark, texts):
    rows = {r.doc_id: r for r in bpe.digests(frame(spark, texts), RANKS, PATTERN).collect()}
    for k, t in enumerate(texts):
        ids = LIBRARY.encode_ordinary(t or "")
        assert rows[k].n_tokens == len(ids)
        assert rows[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert rows[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def brute_plain(text):
    out = []
    for number, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            luhn = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and luhn,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((number, *m.span()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text("a@.b-+ 1é", max_size=60), st.text("0123.+ -()", max_size=60)))
def test_plain_personal_data(text):
    assert sorted(pii.plain_spans(text)) == sorted(brute_plain(text))


@pytest.mark.parametrize(
    "text, kind, shown",
    [
        ("write to jane dot doe at mail dot example dot com today", "email", "jane dot doe at mail dot example dot com"),
        ("write to jane.doe [at] example [dot] com today", "email", "jane.doe [at] example [dot] com"),
        ("write to jane(at)example.com today", "email", "jane(at)example.com"),
        ("write to jаne@exаmple.com today", "email", "jаne@exаmple.com"),
        ("call +1 five five five one two three four five six seven now", "phone", "+1 five five five one two three four five six seven"),
        ("host １９２.１６８.０.１ is down", "ip", "１９２.１６８.０.１"),
        ("card four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"),
    ],
)
def test_disguised_personal_data(text, kind, shown):
    plain, every = pii.spans(text)
    found = [text[s:e] for k, s, e in every if pii.KINDS[k] == kind]
    assert shown in found
    assert not [x for x in plain if text[x[1] : x[2]] == shown]


@pytest.mark.parametrize(
    "kind, shown",
    [
        ("email", "jane@example dot com"), ("ip", "192 dot 168 dot 0 dot 1"), ("ip", "192 point 168 point 0 point 1"),
        ("phone", "plus 44 20 7946 0958"), ("email", "jane at\nexample dot com"), ("email", "jane@example point com"),
        ("email", "jane @ example.com"), ("email", "jane[at]example.com"), ("email", "jane@example[.]com"),
    ],
)
def test_each_disguise_alone(kind, shown):
    for text in (shown, f"see {shown}; or not", f"see {shown}; or not \u3042"):
        assert shown in [text[s:e] for k, s, e in pii.spans(text)[1] if pii.KINDS[k] == kind]


@pytest.mark.parametrize(
    "kind, shown",
    [
        ("phone", "+1 555 five five five 0199"), ("ip", "192.168.0.one"), ("ip", "one.168.0.1"), ("ip", "192.one.two.1"),
        ("ip", "192 dot 168 dot 0 dot one"), ("phone", "+one 555 555 0199"), ("card", "4111 1111 1111 111 one"),
    ],
)
def test_number_words_beside_digits(kind, shown):
    for text in (shown, f"see {shown}; or not"):
        assert shown in [text[s:e] for k, s, e in pii.spans(text)[1] if pii.KINDS[k] == kind]
    assert not pii.spans("one of 3, or two. In 2019 three of us had 5 + one")[1]


def test_clean_texts_have_no_spans(spark, texts):
    rows = pii.find_personal_data(frame(spark, [*texts, "the one at home. Two dots at 5. one two", "élan à la carte – ok"]))
    assert {r.spans for r in rows.collect()} == {""}
    assert pii.masked("mail a@b.c, +1 (456) 555-2186!") == "mail [EMAIL], [PHONE]!"


def test_url_filter(spark):
    urls = [
        (0, None), (1, ""), (2, "no scheme"), (3, "http://A.Example.NET/en/x"), (4, "http://example.net/de/x?y=/en/"),
        (5, "https://x.org/fr/"), (6, "https://x.org/fr"), (7, "http://net"), (8, "http://net/"), (9, "http://badexample.com/de/"),
        (10, "ftp://www.example.com/de/a#b"), (10, "ftp://www.example.com/de/a#b"), (None, "http://a.net/"),
    ]
    rows = url_filter.filter_urls(spark.createDataFrame(urls, "page_id long, url string"), RULES).collect()
    got = [(r.page_id, r.rule, r.verdict) for r in sorted(rows, key=lambda r: (r.page_id is None, r.page_id))]
    assert got == [
        (0, None, "allow"), (1, None, "allow"), (2, None, "allow"), (3, "example.net/en/", "allow"), (4, "net/", "block"),
        (5, "org/fr/", "allow"), (6, None, "allow"), (7, None, "allow"), (8, "net/", "block"), (9, None, "allow"),
        (10, "example.com/de/", "block"), (10, "example.com/de/", "block"), (None, "net/", "block"),
    ]


def test_quality_rules(spark, texts):
    good, bad = prose(30, 80, 10_000), "x y z " * 40
    rows = [(k, good, "fine") for k in range(20)] + [(20 + k, bad, "spam") for k in range(20)] + [(40, good, "spam"), (41, None, None)]
    judged = quality_rules.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    kept = {r.doc_id: r.kept for r in judged}
    assert all(kept[k] for k in range(20)) and not any(kept[k] for k in range(20, 42))
    for r in quality_rules.measures(frame(spark, texts)).collect():
        words = WORD.findall(texts[r.doc_id] or "")
        grams = list(zip(words, words[1:], words[2:]))
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)} if len(words) < 500 else None
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert again is None or r.n_repeat_words == len(again)


def test_nearest(spark):
    rng = np.random.default_rng(4)
    points = [(int(i), [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 8)))]
    points += [(300 + k, points[7][1]) for k in range(40)]
    odd = [(400, None), (401, [0.0] * 8), (402, [float("nan")] + [1.0] * 7), (403, [None] + [1.0] * 7), (404, [1.0] * 3), (None, [1.0] * 8)]
    table = spark.createDataFrame(points + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "vid", "i", "rank")})
    got = {}
    assert ann.nearest(table.limit(0), table).count() == ann.nearest(table, table.limit(0)).count() == 0
    for r in ann.nearest(table, table.where(F.col("vec_id") % 20 == 0), k=20, probe_share=1.0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    x = np.array([v for _, v in points])
    assert set(got) == set(range(0, 340, 20))
    for q, rows in got.items():
        score = [(-sum(a * b for a, b in zip(x[q], v)), i) for i, v in enumerate(x.tolist()) if i != q]
        assert [(k, i) for k, i, _ in sorted(rows)] == [(k + 1, i) for k, (_, i) in enumerate(sorted(score)[:20])]


@pytest.mark.parametrize("rows, clustered", [(20_000, False), (80_000, False), (80_000, True)])
def test_recall_of_nearest(spark, tmp_path, rows, clustered):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(5)
    x = rng.normal(size=(rows, 64))
    if clustered:
        x = 0.4 * x + rng.normal(size=(100, 64))[rng.integers(0, 100, rows)]
    x /= np.sqrt((x * x).sum(1))[:, None]
    column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 64).cast(pa.list_(pa.float64()))
    pq.write_table(pa.table({"vec_id": np.arange(rows), "embedding": column}), tmp_path / "x.parquet")
    table, got = spark.read.parquet(str(tmp_path / "x.parquet")), {}
    for r in ann.nearest(table, table.where(F.col("vec_id") % 500 == 0), k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, rows, 500))
    found = 0
    for q, hits in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        assert [k for k, _, _ in sorted(hits)] == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-12 for _, v, s in hits) and [s for _, _, s in sorted(hits)] == sorted((s for _, _, s in hits), reverse=True)
        found += len({v for _, v, _ in hits} & set(np.argsort(-score)[:20].tolist()))
    assert found / len(got) / 20 >= 0.9


def test_queries_meet_only_their_leaves():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(20_000, 16))
    x /= np.sqrt((x * x).sum(1))[:, None]
    forest = ann.Forest([], 1.0)
    forest = ann.Forest([ann.grow(forest.lengthened(x[:5000]), 7, np.random.default_rng(t)) for t in range(4)], 1.0)
    visits = forest.probe(x[0], 0.1)
    assert len(visits) == len(set(visits.tolist())) == int(np.ceil(0.1 * forest.numbered()[-1]))
    leaf = forest.leaves_of(forest.lengthened(x)) + forest.numbered()[:-1]
    assert set(leaf[0].tolist()) & set(visits.tolist())
    at, who, scores = ann.rank_in_leaves(x, leaf, x[:1], [visits], 21)
    allowed = np.flatnonzero(np.isin(leaf, visits).any(1))
    assert len(allowed) < 0.5 * len(x)
    assert who.tolist() == allowed[np.argsort(-(x[allowed] @ x[0]))][:21].tolist() and set(at) == {0}
    assert len(forest.probe(x[0], 1.0)) == forest.numbered()[-1]


def test_isotonic_and_label_model():
    fit = quality_model.isotonic(np.array([1.0, 1, 0, 1, 2]), np.array([0.0, 1, 0, 0, 2]))
    assert np.all(np.diff(fit) >= 0) and fit[0] == 0 and fit[-1] == 1
    rng = np.random.default_rng(0)
    truth = rng.random(2000) < 0.2
    votes = (rng.random((2000, 6)) < np.where(truth[:, None], 0.6, 0.02)).astype(float)
    votes[:, 5] = votes[:, 4]  # two voters that always agree
    posterior = toxicity.label_posterior(votes, truth.astype(float), 0.2)
    assert ((posterior > 0.5) == truth).mean() > 0.97


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_model.score_quality(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    assert not [r for r in rows if r.predicted and not r.toxic]
