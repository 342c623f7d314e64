"""Host-level quality rules, in DataFrame functions only.

Each document is measured and fails the base rules on its own. Failures are summed by host (the
document's source), the hosts' failure rates are shrunk with an empirical beta prior, and a host
whose shrunk rate is above `max_rate` loses all its documents.

Null or empty texts have zero of everything and fail (too few words). Documents without a source
form one host of their own. Repeated rows count as often as they occur. An empty table gives an
empty result; one host alone, or hosts that differ by no more than chance, get the strongest prior.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.session import materialise

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
# Weight of the prior, in documents, when hosts do not differ measurably; and the least weight.
STRONGEST_PRIOR = 1e6
WEAKEST_PRIOR = 1e-3
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)`, with `value` computed once however often and deeply `body` uses it."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more in the array, each word once.

    Windows are sorted as (hash, position), so that equal ones are neighbours; the words they cover
    are added up along the positions. Nothing leaves the row, and the cost is n log n in its words.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)

    def positions(ordered: Column) -> Column:
        def again(x: Column, k: Column) -> Column:
            after = F.get(ordered, k + 1)["h"]
            before = F.when(k > 0, F.get(ordered, k - 1)["h"])
            return F.coalesce(x["h"] == after, F.lit(False)) | F.coalesce(x["h"] == before, F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, again), lambda x: x["i"]))

    found = _let(F.sort_array(windows), lambda ordered: _let(positions(ordered), covered))
    return F.when(F.size(words) >= 3, found).otherwise(F.lit(0).cast("bigint"))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source and the measures of every row; the text goes no further than this."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")
    lines = F.filter(
        F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != ""
    )
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    read = docs.select("doc_id", "source", text.alias("text"), words.alias("words"), lines.alias("lines"))
    return read.select(
        "doc_id",
        "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("bigint").alias("word_chars"),
        F.length("text").cast("bigint").alias("n_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per source: documents, failures, shrunk failure rate, and whether the host is rejected.

    The prior's mean is the rate of all documents; its weight follows from the variance between
    hosts that remains after the binomial one is taken off.
    """
    hosts = materialise(
        judged.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("f")),
        "hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("h")).first()
    n, f, h = total["n"] or 0, total["f"] or 0, total["h"]
    mean = f / n if n else 0.0
    spread = hosts.agg(
        F.sum(F.col("n") * (F.col("f") / F.col("n") - mean) * (F.col("f") / F.col("n") - mean)).alias("q"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
    ).first()
    binomial = mean * (1 - mean)
    room = n - (spread["nn"] or 0.0) / n if n else 0.0
    between = ((spread["q"] or 0.0) - (h - 1) * binomial) / room if room > 0 else 0.0
    weight = STRONGEST_PRIOR
    if between > 0 and binomial > 0:
        weight = min(STRONGEST_PRIOR, max(WEAKEST_PRIOR, binomial / between - 1))
    rate = (F.col("f") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("source", "n", "f", rate.alias("host_rate")).withColumn(
        "host_rejected", F.col("host_rate") > F.lit(max_rate)
    )


def judge_documents(docs: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, base_failed, host_rate and kept of every document.

    The measures are written once to the shared folder: hosts are summed from them (with partial
    sums, so a host with a third of all rows is no hot spot) and the verdicts are joined back to
    them. The join moves narrow rows; Spark broadcasts the hosts only if their table is small.
    """
    judged = materialise(
        measures(docs.select("doc_id", "text", "source")).withColumn("base_failed", base_failed()), "measures"
    )
    verdicts = host_verdicts(judged, max_rate).select(
        F.col("source").alias("_host"), "host_rate", "host_rejected"
    )
    joined = judged.join(verdicts, F.col("source").eqNullSafe(F.col("_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("_host", "host_rejected")
