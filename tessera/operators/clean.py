"""Row and column cleaning, and the two cleaning pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONTENT, RAW_CONTENT, RAW_DROPPED, TASKS, TITLE
from ..functions.text import clean_text, trimmed
from .encode import encode


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns; an absent one is an error."""
    if gone := set(columns) - set(df.columns):
        raise ValueError(f"no such columns: {sorted(gone)}")
    return df.drop(*columns)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows without null in the subset, or in any column."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def fill_missing(df: DataFrame, columns: Sequence[str], value: str = "") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in columns})


def dedupe_first(df: DataFrame, order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The first row by order of each combination of columns (all but order, if not given); nulls are equal."""
    by = list(columns) if columns else [c for c in df.columns if c != order]
    rest = [c for c in df.columns if c not in by and c != order]
    if not rest:
        return df.groupBy(*by).agg(F.min(order).alias(order)).select(*df.columns)
    first = df.groupBy(*by).agg(F.min_by(F.struct(order, *rest), order).alias("__first"))
    return first.select(*by, "__first.*").select(*df.columns)


def clean_raw(df: DataFrame, order: str = "ord", dropped: Sequence[str] = RAW_DROPPED, content: str = RAW_CONTENT) -> DataFrame:
    """De-duplicate whole rows first, so that equal texts with different links survive; then drop columns and rows without
    content. Rows with null in other columns stay."""
    return drop_missing(drop_columns(dedupe_first(df, order), dropped), [content])


def clean_labelled(df: DataFrame, tasks: Mapping[str, Sequence[str]] = TASKS, title: str = TITLE, content: str = CONTENT, normalize: bool = True) -> DataFrame:
    """Clean title and content, trim labels, drop rows with an empty text, then encode: a bad label on a dropped row is no
    error, one on a kept row is."""
    texts = {c: clean_text(F.col(c), normalize) for c in (title, content)}
    labels = {t: trimmed(F.col(t).cast("string")) for t in tasks}
    kept = df.withColumns(texts | labels).where((F.col(title) != "") & (F.col(content) != ""))
    return encode(kept, tasks)


def nonempty_counts(df: DataFrame, title: str, content: str) -> DataFrame:
    """One row (n_kept, n_dropped) of the non-empty filter."""
    full = (F.col(title) != "") & (F.col(content) != "")
    return df.agg(F.count_if(F.coalesce(full, F.lit(False))).alias("n_kept"), F.count_if(~F.coalesce(full, F.lit(False))).alias("n_dropped"))


def features_only(df: DataFrame, tasks: Mapping[str, Sequence[str]] = TASKS, title: str = TITLE, content: str = CONTENT) -> DataFrame:
    """What a model may see: both texts and the label ids."""
    return df.select(title, content, *(f"{t}_id" for t in tasks))
