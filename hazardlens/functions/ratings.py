"""Ordinal exposure ratings: A is the lowest exposure, G the highest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.functions.text import _col, strip

# fixed value: letters from best to worst
LETTERS = "ABCDEFG"


def rating_score(c) -> Column:
    """1 for A to 7 for G, 0 for anything else; case and outer space do not matter."""
    text = _col(c)
    trimmed = strip(text)

    def place(letter):
        return F.position(F.upper(letter), F.lit(LETTERS))

    # nearly every rating is one bare letter, and only the rest is worth trimming
    return (
        F.when(text.isNull(), 0)
        .when(F.length(text) == 1, place(text))
        .when(F.length(trimmed) == 1, place(trimmed))
        .otherwise(0)
    )


def rating_letter(score) -> Column:
    """The letter of a score, null outside 1..7."""
    s = _col(score).cast("int")
    return F.when(s.between(1, len(LETTERS)), F.substring(F.lit(LETTERS), s, F.lit(1)))


def worst_score(*cols) -> Column:
    scores = [rating_score(c) for c in cols]
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def worst_rating(*cols) -> Column:
    return rating_letter(worst_score(*cols))


def rating_band(c) -> Column:
    score = rating_score(c)
    return (
        F.when(score == 0, "No rating")
        .when(score <= 2, "Lower exposure")
        .when(score <= 4, "Moderate exposure")
        .otherwise("Higher exposure")
    )


def rating_tone(c) -> Column:
    score = rating_score(c)
    return F.when(score >= 5, "high").when(score >= 3, "mid").otherwise("low")
