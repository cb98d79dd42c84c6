"""Posts from an XML dump with one element per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.functions.text import tag_list, year_of
from rillstone.schemas import POST_ATTRIBUTES


def parse_posts(lines: DataFrame) -> DataFrame:
    """``(Id, CreationDate, Tags)`` of every well-formed row element; a missing attribute is ''.

    Header, footer and broken lines have no readable row element, so no line numbers are needed.
    """
    row = F.from_xml("value", POST_ATTRIBUTES, {"rowTag": "row", "mode": "PERMISSIVE"})
    candidates = lines.filter(F.col("value").rlike(r"^\s*<row\s"))
    # The one-element generator parses a line once for all later filters and columns.
    parsed = candidates.select(F.inline(F.array(row)))
    readable = parsed.filter(F.coalesce("_Id", "_CreationDate", "_Tags").isNotNull())
    return readable.select(*[F.coalesce(F.col(f"_{n}"), F.lit("")).alias(n) for n in ("Id", "CreationDate", "Tags")])


def post_tags(posts: DataFrame, mode: str = "every") -> DataFrame:
    """``(Year, Language)`` per tag; posts without a readable date are left out."""
    return posts.select(
        year_of(F.col("CreationDate")).alias("Year"), F.explode(tag_list(F.col("Tags"), mode)).alias("Language")
    ).filter(F.col("Year").isNotNull())
