"""Toxicity by weak supervision.

1. Lexicons are mined from a bounded sample of labelled training rows: words and word beginnings
   that toxic texts hold and others do not, in different surroundings (so that copies of one text
   do not count as evidence).
2. Voters: the mined words and beginnings in several groups each, a fixed word list, and patterns.
   A voter votes "toxic" where it finds something, else it votes "not".
3. A generative label model estimates, without looking at single labels, how often each voter
   fires in toxic and other texts (EM over a two-class model) and how voters correlate given the
   class; correlated voters share their weight. The labels enter as one more voter of known accuracy.
4. A linear classifier is trained on the posterior labels, over counts of what the voters found.

Null and empty texts find nothing and get the score of a text without hits. Repeated rows and rows
without id are scored like others. Without any labels the fixed lists alone vote. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import label_split, map_batches, one_label, texts_of

# Labelled training rows that are read, at most (those of the smallest hashes).
SAMPLE_ROWS = 12_000
MAX_LEXICON = 3_000
WORD_GROUPS, PREFIX_GROUPS = 12, 4
PREFIX_CHARS, PREFIXED_CHARS = 4, 6
# What a token must have to be taken. Beginnings join many words, so chance favours them more often.
LEAST_SURROUNDINGS, LEAST_PRECISION, LEAST_GAIN, LEAST_PREFIX_GAIN = 4, 0.6, 30.0, 60.0
SURROUNDINGS = 61  # surroundings are told apart by a hash of so many values
GOLD_ACCURACY = 0.95
EM_ROUNDS = 40
# Common English insults.
INSULTS = frozenset(
    "asshole bastard bitch clown crap cretin damn disgusting dumb dumbass filth freak fool garbage hate "
    "idiot idiotic imbecile jerk loser moron moronic pathetic pig retard scum shit shitty stupid trash "
    "ugly vermin worthless".split()
)
_LETTERS = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"\b[A-Za-z][*#$@]{2,}[A-Za-z]*")
VOTERS = WORD_GROUPS + PREFIX_GROUPS + 4


@dataclass(frozen=True)
class Lexicon:
    words: dict[str, int]  # to their voter
    prefixes: dict[str, int]


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # the last one is the intercept


def findings(text: str, lexicon: Lexicon) -> np.ndarray:
    """How much each voter finds."""
    out = np.zeros(VOTERS)
    words = _LETTERS.findall(text.lower())
    distinct = set(words)
    hits = distinct & lexicon.words.keys()
    starts = {w[:PREFIX_CHARS] for w in distinct if len(w) >= PREFIXED_CHARS} & lexicon.prefixes.keys()
    insults = distinct & INSULTS
    if hits or insults:
        for w in words:
            if w in hits:
                out[lexicon.words[w]] += 1
            if w in insults:
                out[WORD_GROUPS + PREFIX_GROUPS] += 1
    if starts:
        for w in words:
            if len(w) >= PREFIXED_CHARS and w[:PREFIX_CHARS] in starts:
                out[lexicon.prefixes[w[:PREFIX_CHARS]]] += 1
    found = out[:WORD_GROUPS].sum() + out[WORD_GROUPS + PREFIX_GROUPS]
    out[-3] = max(0.0, found - 1)  # several at once
    out[-2] = len(_MASKED.findall(text)) if "*" in text or "#" in text or "@" in text or "$" in text else 0
    share = found / len(words) if words else 0.0
    out[-1] = 1.0 if share > 0.02 else 0.0
    return out


def inputs(found: np.ndarray) -> np.ndarray:
    """Inputs of the classifier from a matrix of findings."""
    lexical = found[:, :WORD_GROUPS].sum(1)
    starts = found[:, WORD_GROUPS : WORD_GROUPS + PREFIX_GROUPS].sum(1)
    kinds = (found[:, : WORD_GROUPS + PREFIX_GROUPS + 1] > 0).sum(1)
    extra = np.log1p(np.stack([lexical, starts, np.maximum(lexical, starts), kinds], 1))
    return np.hstack([np.log1p(found), extra, np.ones((len(found), 1))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def label_posterior(votes: np.ndarray, gold: np.ndarray, base: float) -> np.ndarray:
    """Probability of the toxic class by row, from 0/1 votes and the labels as one more voter."""
    n = len(votes)
    q = np.where(votes.sum(1) >= 2, 0.9, 0.02)
    prior = np.log(base / (1 - base))
    said = np.where(gold > 0, 1, -1) * np.log(GOLD_ACCURACY / (1 - GOLD_ACCURACY))
    for _ in range(EM_ROUNDS):
        yes, no = q.sum() + 1, n - q.sum() + 1
        fires = np.clip((q @ votes + 0.5) / yes, 1e-4, 1 - 1e-4)
        false = np.clip(((1 - q) @ votes + 0.1) / no, 1e-4, 1 - 1e-4)
        # What is left when the class is known: voters that still move together share their weight.
        rest = votes - (q[:, None] * fires + (1 - q)[:, None] * false)
        scale = np.sqrt((rest**2).mean(0)) + 1e-9
        related = np.clip((rest.T @ rest) / n / np.outer(scale, scale), 0, 1)
        np.fill_diagonal(related, 0)
        weight = 1 / (1 + (related**2).sum(0))
        for_yes, for_no = np.log(fires / false), np.log((1 - fires) / (1 - false))
        logit = prior + votes @ (weight * for_yes) + (1 - votes) @ (weight * for_no)
        new = _sigmoid(logit)
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return _sigmoid(logit + said)


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the intercept is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(60):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (p - target) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _token_rows(docs: DataFrame) -> DataFrame:
    """token, label and one bit of 64 for its surroundings, once per document and token."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens, labels, bits = [], [], []
        for text, label in zip(texts_of(batch), batch.column("label").to_pylist()):
            words = _LETTERS.findall(text.lower())
            first: dict[str, int] = {}
            for k, w in enumerate(words):
                first.setdefault(w, k)
                if len(w) >= PREFIXED_CHARS:
                    first.setdefault(f"{w[:PREFIX_CHARS]}*", k)
            for token, k in first.items():
                around = (words[k - 1] if k else "") + " " + (words[k + 1] if k + 1 < len(words) else "")
                tokens.append(token)
                labels.append(label)
                bits.append(1 << sum(around.encode()) * 31 % SURROUNDINGS)
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.string()), pa.array(labels, pa.int32()), pa.array(bits, pa.int64())],
            names=["token", "label", "bit"],
        )

    return map_batches(docs, lambda: step, "token string, label int, bit long")


def mine_lexicon(sample: DataFrame, toxic: int, clean: int) -> Lexicon:
    """The tokens that tell toxic texts best; at most MAX_LEXICON of them reach the driver."""
    is_toxic = F.col("label") == 1
    counted = _token_rows(sample).groupBy("token").agg(
        F.sum(F.when(is_toxic, 1).otherwise(0)).alias("a"),
        F.sum(F.when(is_toxic, 0).otherwise(1)).alias("b"),
        F.bit_count(F.bit_or(F.when(is_toxic, F.col("bit")).otherwise(F.lit(0).cast("bigint")))).alias("seen"),
    )
    base = toxic / max(1, toxic + clean)
    # Occurrences that the different surroundings stand for: copies of one text hardly add any.
    apart = F.least(F.col("a").cast("double"), -SURROUNDINGS * F.log1p(-F.col("seen") / F.lit(SURROUNDINGS + 1)))
    counted = counted.withColumn("a", apart)
    n = F.col("a") + F.col("b")
    gain = 2 * (
        F.col("a") * F.log(F.col("a") / (n * base))
        + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (n * (1 - base)))).otherwise(0.0)
    )
    telling = (
        counted.where((F.col("seen") >= LEAST_SURROUNDINGS) & (F.col("a") >= LEAST_PRECISION * n))
        .withColumn("gain", gain)
        .where(F.col("gain") >= F.when(F.endswith("token", F.lit("*")), LEAST_PREFIX_GAIN).otherwise(LEAST_GAIN))
        .orderBy(F.desc("gain"), "token")
        .limit(MAX_LEXICON)
        .select("token")
    )
    words: dict[str, int] = {}
    prefixes: dict[str, int] = {}
    for (token,) in telling.collect():
        if token.endswith("*"):
            prefixes[token[:-1]] = WORD_GROUPS + len(prefixes) % PREFIX_GROUPS
        else:
            words[token] = len(words) % WORD_GROUPS
    return Lexicon(words, prefixes)


def _found(docs: DataFrame, lexicon: Lexicon, others: list[str]) -> DataFrame:
    handle = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        known = handle.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [findings(t, known).tolist() for t in texts_of(batch)]
            return pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(rows, pa.list_(pa.float64()))], names=[*others, "found"]
            )

        return step

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in others)
    return map_batches(docs.select("text", *others), make, f"{schema}, found array<double>")


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows whose id hash modulo `modulus` is not `held_out`, `sample_rows` at most."""
    known = one_label(labels, "toxic").where(label_split("doc_id", modulus) != held_out)
    # The sample's ids are bounded by the parameter, so they may be broadcast to the texts.
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    sample = texts.join(F.broadcast(ids), "doc_id").select("text", F.col("label").cast("int").alias("label"))
    sizes = {label: n for label, n in sample.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        weights = np.zeros(VOTERS + 5)
        weights[WORD_GROUPS + PREFIX_GROUPS], weights[-1] = 2.5, -3.0
        return Model(Lexicon({}, {}), weights)
    lexicon = mine_lexicon(sample, toxic, clean)
    rows = _found(sample, lexicon, ["label"]).collect()
    gold = np.array([r["label"] for r in rows], dtype=float)
    found = np.array([r["found"] for r in rows])
    order = np.lexsort([*found.T, gold])  # the order of rows from tasks must not change the sums
    gold, found = gold[order], found[order]
    posterior = label_posterior((found > 0).astype(float), gold, toxic / (toxic + clean))
    return Model(lexicon, fit_linear(inputs(found), posterior))


def score_texts(docs: DataFrame, model: Model, columns: list[str], score: str = "score") -> DataFrame:
    """`columns` of every row and its score."""
    handle = docs.sparkSession.sparkContext.broadcast(model)
    kinds = dict(docs.dtypes)

    def make():
        known = handle.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([findings(t, known.lexicon) for t in texts_of(batch)])
            scores = _sigmoid(inputs(found) @ known.weights)
            return pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], pa.array(scores, pa.float64())], names=[*columns, score]
            )

        return step

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns)
    return map_batches(docs.select(*dict.fromkeys([*columns, "text"])), make, f"{schema}, `{score}` double")


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = score_texts(docs, train(docs, labels, modulus, held_out), ["doc_id"])
    return scored.select(
        "doc_id",
        F.coalesce(label_split("doc_id", modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
