"""Text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.parsing import words


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each lower-cased word, most frequent first, ties by word."""
    exploded = df.select(F.explode(words(text)).alias("word"))
    return exploded.groupBy("word").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "word")
