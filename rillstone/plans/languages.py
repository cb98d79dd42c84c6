"""Most mentioned programming languages per year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def language_counts(tags: DataFrame, languages: DataFrame, first_year: int = 2010, last_year: int = 2020) -> DataFrame:
    """``(Year, Language, Count)`` of the tags that name a known language.

    Mentions are counted before they meet the dictionary, so a frequent language is a few rows there.
    """
    counts = (
        tags.filter(F.col("Year").between(first_year, last_year))
        .groupBy("Year", "Language")
        .agg(F.count(F.lit(1)).alias("Count"))
    )
    known = languages.select(F.lower("name").alias("Language")).distinct()
    return counts.join(known, "Language").select("Year", "Language", "Count")


def top_languages(counts: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` languages of each year with their rank; on a tie by name."""
    order = Window.partitionBy("Year").orderBy(F.desc("Count"), "Language")
    return counts.withColumn("Rank", F.row_number().over(order)).filter(F.col("Rank") <= top)
