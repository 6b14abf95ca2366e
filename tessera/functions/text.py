"""Text cleaning as column functions. Only Unicode normalisation leaves the JVM, in Arrow batches."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \s with (?U), and U+001C to U+001F, are the white space that the cleaning is defined by.
SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
#: Texts that a worker turns into Python strings at once.
FEW_TEXTS = 64
URL = rf"(?U)https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"


def nfkc(column: Column) -> Column:
    """Unicode NFKC. Null gives null. ASCII texts, which it leaves alone, stay in the JVM; of the others a worker holds a few at a
    time as Python strings, beside the Arrow batch and its result."""
    few = FEW_TEXTS

    @F.arrow_udf("string")
    def run(s: pa.Array) -> pa.Array:
        parts = (s.slice(at, few).to_pylist() for at in range(0, max(len(s), 1), few))
        return pa.concat_arrays([pa.array((x if x is None else unicodedata.normalize("NFKC", x) for x in part), s.type) for part in parts])

    return F.coalesce(run(F.when(F.octet_length(column) != F.length(column), column)), column)


def without_urls(column: Column) -> Column:
    return F.regexp_replace(column, URL, " ")


def squeezed(column: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(column, rf"(?U){SPACE}+", " "))


def clean_text(column: Column, normalize: bool = True) -> Column:
    """Null as empty; NFKC, URLs out, white space squeezed. normalize=False skips NFKC for text known to be ASCII."""
    text = F.coalesce(column, F.lit(""))
    return squeezed(without_urls(nfkc(text) if normalize else text))


def trimmed(column: Column) -> Column:
    """Without any white space at the ends; null stays null."""
    return F.regexp_replace(column, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def joint_length(*columns: Column) -> Column:
    """Code points of all columns together, null as empty."""
    total = F.lit(0)
    for c in columns:
        total = total + F.length(F.coalesce(c, F.lit("")))
    return total


def task_name(label: str) -> str:
    return label.replace("_label", "")


def fixed(column: Column, digits: int = 2) -> Column:
    """Text with so many decimals, without grouping."""
    return F.format_string(f"%.{digits}f", column.cast("double"))
