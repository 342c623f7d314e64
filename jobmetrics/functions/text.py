"""Column expressions for untyped log and scheduler text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The number syntax accepted, and the texts that stand for a missing string.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Accounting pseudo-steps of the CPU log, and the GPU resource keys of tres_alloc.
ACCOUNTING_STEPS = (-4.0, -1.0)
TESLA_KEY = "1001="
VOLTA_KEY = "1002="
# <job>-<node...>.<extension>
LOG_FILE_NAME = r"^[^.-]*-([^.]*)"


def to_number(text: Column) -> Column:
    """DOUBLE value of `text`; anything that is not a decimal number becomes NULL.

    The cast alone would also take type suffixes (`12d`), `nan`, `inf` and hexadecimal. `text` is
    used twice only, so that converting many columns stays within compiled code.
    """
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_integer(text: Column) -> Column:
    """BIGINT value of `text`, exact for every whole number; forms like `12.0` count, others are NULL."""
    whole = F.trim(text)
    exact = F.when(whole.rlike(r"^[+-]?[0-9]+$"), whole.try_cast("bigint"))
    return F.when(whole.rlike(r"^[+-]?[0-9]+$"), exact).otherwise(to_number(text).try_cast("bigint"))


def to_text(text: Column) -> Column:
    """String value with the usual missing-value markers turned into NULL."""
    return F.when(~text.isin(*MISSING_TEXT), text)


def is_unparseable(text: Column) -> Column:
    """True where a value is present but is not a number."""
    return F.coalesce(to_text(text).isNotNull() & to_number(text).isNull(), F.lit(False))


def is_accounting_step(step: Column) -> Column:
    """True for the accounting pseudo-steps; a missing step is an ordinary one."""
    return F.coalesce(to_number(step).isin(*ACCOUNTING_STEPS), F.lit(False))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def names_a_node(path: Column) -> Column:
    return file_name(path).rlike(LOG_FILE_NAME)


def node_from_path(path: Column) -> Column:
    """Node id part of a log file name, empty when the name has no dash."""
    return F.regexp_extract(file_name(path), LOG_FILE_NAME, 1)


def allocated_gpus(tres_alloc: Column) -> Column:
    """GPU count of an allocation string: the number after the last '=' of its last component."""
    last_component = F.element_at(F.split(tres_alloc, ","), -1)
    count = F.trim(F.element_at(F.split(last_component, "="), -1)).try_cast("int")
    names_gpus = tres_alloc.contains(TESLA_KEY) | tres_alloc.contains(VOLTA_KEY)
    return F.when(names_gpus, F.coalesce(count, F.lit(0))).otherwise(F.lit(0))


def gpu_type(tres_alloc: Column) -> Column:
    return F.when(tres_alloc.contains(TESLA_KEY), F.lit("tesla")).when(
        tres_alloc.contains(VOLTA_KEY), F.lit("volta")
    )


def split_csv_line(line: Column) -> Column:
    """Fields of one CSV record, quotes removed; absent fields are NULL."""
    plain = F.split(line, ",", -1)
    quoted = F.transform(
        F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1),
        lambda field: F.regexp_replace(
            F.regexp_replace(field, r'^"([\s\S]*)"$', "$1"), '""', '"'
        ),
    )
    return F.when(line.contains('"'), quoted).otherwise(plain)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def comparable_path(path: Column) -> Column:
    """Path without scheme and without URL escapes, so listed and scanned paths can be joined."""
    bare = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    return F.regexp_replace(bare, r"/{2,}", "/")


def scanned_path(file_path: Column) -> Column:
    """`comparable_path` of the `_metadata.file_path` column, which is URL-encoded."""
    decoded = F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))
    return comparable_path(decoded)
