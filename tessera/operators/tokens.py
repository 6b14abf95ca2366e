"""Pair encoding, truncation, batching and padding over token arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BATCH_SIZE, MAX_LENGTH, SEED, SPECIAL_TOKENS
from ..functions.text import squeezed
from .ranking import hash_rank, key_rank


def words(column: Column) -> Column:
    """White-space tokens, inside the JVM; subwords() gives those of a trained vocabulary."""
    text = squeezed(F.coalesce(column, F.lit("")))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def subwords(path: str | None = None):
    """Tokens of a trained vocabulary in place of words: path, or byte_bpe_50k.json of public_tokenizers, by the tokenizers library."""

    def of(column: Column) -> Column:
        @F.pandas_udf("array<string>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            from tokenizers import Tokenizer

            if path is None:
                import public_tokenizers
            t = Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))
            for s in parts:
                yield pd.Series([e.tokens for e in t.encode_batch(s.fillna("").tolist(), add_special_tokens=False)], dtype=object)

        return run(column)

    return of


def encode_pair(df: DataFrame, title: str, content: str, max_length: int = MAX_LENGTH, special: int = SPECIAL_TOKENS, tokenize=words) -> DataFrame:
    """df with title_tokens whole, content_tokens cut to what is left of max_length, n_tokens and over_budget (the title
    alone doesn't fit, so the content is empty)."""
    room = F.lit(max_length - special) - F.size("title_tokens")
    out = df.withColumns({"title_tokens": tokenize(F.col(title)), "content_tokens": tokenize(F.col(content))})
    out = out.withColumn("content_tokens", F.slice("content_tokens", F.lit(1), F.greatest(room, F.lit(0))))
    return out.withColumns({"n_tokens": F.size("title_tokens") + F.size("content_tokens") + special, "over_budget": room < 0})


def batched(df: DataFrame, key: str, size: int = BATCH_SIZE, shuffle: bool = False, seed: int = SEED) -> DataFrame:
    """df with batch: rows in the order of key, or of a hash of it if shuffled, size a batch."""
    ranked = hash_rank(df, [], key, seed, "__rank") if shuffle else key_rank(df, key, "__rank")
    return ranked.withColumn("batch", F.floor(F.col("__rank") / size)).drop("__rank")


def padded(df: DataFrame, tokens: str, batch: str = "batch", fill: str = "[PAD]") -> DataFrame:
    """df with tokens padded to the longest of the batch, and attention mask."""
    longest = df.groupBy(batch).agg(F.max(F.size(tokens)).alias("__longest"))
    short = F.col("__longest") - F.size(tokens)
    mask = F.concat(F.array_repeat(F.lit(1), F.size(tokens)), F.array_repeat(F.lit(0), short))
    return df.join(longest, batch).withColumn("mask", mask).withColumn(tokens, F.concat(F.col(tokens), F.array_repeat(F.lit(fill), short))).drop("__longest")
