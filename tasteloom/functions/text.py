"""Text rules of catalog search and suggestion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokenize_query(col: Column) -> Column:
    """Lower-cased whitespace tokens without blanks."""
    return F.filter(F.split(F.lower(col), r"\s+"), lambda t: t != "")


def catalog_text(title: str = "title", brand: str = "brand", category: str = "category") -> Column:
    return F.lower(F.concat_ws(" ", *(F.coalesce(F.col(c), F.lit("")) for c in (title, brand, category))))


def split_words(text: Column) -> Column:
    return F.split(text, "[^a-z0-9]+")


def is_suggestable(word: Column, min_length: int = 3) -> Column:
    return (F.length(word) >= min_length) & ~word.rlike("^[0-9]+$")
