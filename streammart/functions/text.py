"""Splitting a search phrase into words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: what separates words.
BETWEEN_WORDS = r"[^\p{L}\p{N}]+"


def words_of(phrase: Column | str) -> Column:
    """The distinct words of a phrase: runs of letters and digits, lower-cased."""
    phrase = F.col(phrase) if isinstance(phrase, str) else phrase
    parts = F.split(F.lower(phrase), BETWEEN_WORDS)
    return F.array_distinct(F.filter(parts, lambda w: w != ""))


def explode_words(
    df: DataFrame,
    phrase: str,
    word: str = "word",
    segmenter: Callable[[str], Iterable[str]] | None = None,
) -> DataFrame:
    """One row per distinct word of ``phrase``; a phrase without words yields no row.

    Scripts without spaces need a dictionary: pass ``segmenter``, a function from a phrase to its
    words. It then runs in Arrow batches on the executors.
    """
    if segmenter is None:
        words = words_of(phrase)
    else:

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def segmented(phrases: pd.Series) -> pd.Series:
            return phrases.map(lambda p: None if p is None else list(dict.fromkeys(segmenter(p))))

        words = segmented(F.col(phrase))
    return df.withColumn(word, F.explode(words))


def register_functions(spark: SparkSession, name: str = "split_words") -> None:
    """Make the word split available to SQL: ``FROM t, LATERAL split_words(t.keyword)``."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING) RETURNS TABLE (word STRING)
        RETURN SELECT explode(array_distinct(filter(
          split(lower(phrase), r'{BETWEEN_WORDS}'), w -> w <> ''))) AS word"""
    )
