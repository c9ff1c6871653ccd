"""Reports over dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category(error: Column) -> Column:
    """What an error is about: the text before the first colon."""
    return F.substring_index(error, ":", 1)


def category_counts(letters: DataFrame, at: str, width: str = "1 day") -> DataFrame:
    """Errors per time window and category: ``window_start, category, n``."""
    return (
        letters.select(F.col(at), F.explode("errors").alias("error"))
        .groupBy(F.window(at, width).alias("w"), category(F.col("error")).alias("category"))
        .agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("window_start"), "category", "n")
    )


def top_categories(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent categories of each window; ties go by name."""
    ranked = Window.partitionBy("window_start").orderBy(F.desc("n"), "category")
    return counts.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= k)


def letter_rate(events: DataFrame, at: str, width: str = "1 day") -> DataFrame:
    """Messages and dead letters per time window, with their ratio."""
    return (
        events.groupBy(F.window(at, width).alias("w"))
        .agg(
            F.count("*").alias("n_messages"),
            F.count_if(F.size("errors") > 0).alias("n_dead"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            "n_messages",
            "n_dead",
            (F.col("n_dead") / F.col("n_messages")).alias("dead_ratio"),
        )
    )
