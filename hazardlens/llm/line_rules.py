"""Quality rules, line by line first: bad lines go, then texts that lost too much."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_RUN = r"[\x20\x09-\x0D]+"
NOT_WORD_OR_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class LineRules:
    """What makes a line fail, and how much of a text may go.

    ``open_end_words``: a line of fewer words must end like a sentence.
    ``separators``: so many bars, arrows or bullets make a line navigation.
    ``boilerplate``: a line with one of these phrases (lower case) fails.
    ``lost_percent``: a text that loses more of its word characters is rejected.
    """

    open_end_words: int = 4
    separators: int = 3
    boilerplate: tuple[str, ...] = (
        "all rights reserved",
        "terms of use",
        "terms of service",
        "privacy policy",
        "cookie policy",
        "use of cookies",
        "enable javascript",
        "lorem ipsum",
        "click here",
        "subscribe to our newsletter",
        "skip to content",
    )
    lost_percent: int = 50

    @property
    def end_pattern(self) -> str:
        return r"[.!?:;…。！？][)\]\"'»”’]*[\x20\x09-\x0D]*\z"

    @property
    def separator_pattern(self) -> str:
        return r"[|>»•·]"


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def line_fails(line: Column, rules: LineRules) -> Column:
    """Why a line goes: ``punctuation``, ``navigation`` or ``boilerplate``; null if it stays.

    A line without a word stays: there is nothing to lose.
    """
    lower = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in rules.boilerplate:
        boilerplate = boilerplate | F.contains(lower, F.lit(phrase))
    seps = F.length(line) - F.length(F.regexp_replace(line, rules.separator_pattern, ""))
    n_words = F.size(word_list(line))
    return (
        F.when(~line.rlike(NOT_WORD_OR_SPACE), F.lit(None).cast("string"))
        .when(boilerplate, "boilerplate")
        .when(seps >= rules.separators, "navigation")
        .when(~line.rlike(rules.end_pattern) & (n_words < rules.open_end_words), "punctuation")
    )


def window_hashes(hashes: Column, window: int = WINDOW) -> Column:
    """A hash of every run of ``window`` words, from one hash per word; null for fewer words."""
    size = F.size(hashes)
    places = F.sequence(F.lit(0), size - window)
    return F.when(size >= window, F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(window)])))


def covered(windows: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window that occurs twice or more.

    Windows are sorted by content beside their place; equal neighbours are repeats, and
    the places found, sorted, give the words they cover. Every step takes n log n.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(p: Column) -> Column:
        return F.sort_array(
            F.filter(
                F.transform(
                    p,
                    lambda x, j: F.when(
                        (F.get(p, j - 1)["h"] == x["h"]) | (F.get(p, j + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
        )

    # each step is bound to a name of its own by a transform over one element, so that it is computed once
    return F.get(
        F.transform(
            F.transform(F.array(pairs), places),
            lambda s: F.aggregate(
                F.transform(
                    s, lambda i, j: F.least(F.lit(window), F.coalesce(F.get(s, j + 1) - i, F.lit(window)))
                ),
                F.lit(0).cast("bigint"),
                lambda total, x: total + x,
            ),
        ),
        F.lit(0),
    )


def clean_lines(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """``df`` with ``clean_text``, counts of words, symbols and repeats, and the verdicts.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` count over the whole
    text; ``base_failed`` is under 20 words, or over 30 % of words in repeated windows.
    ``clean_text`` holds the lines that pass, ``n_lines_removed`` and ``lost_chars`` what
    went; ``kept`` is false for a text that fails the base rules, loses more than
    ``lost_percent`` of its word characters, or has none left.

    A null text counts as empty, which fails the base rules. Input columns with the names
    of the results are replaced; repeated rows get the same result each; an empty table
    gives an empty one. Texts are read whole, at any length.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n", -1)
    step = df.withColumns({"_words": F.transform(word_list(whole), lambda w: F.xxhash64(w)), "_lines": lines})
    worded = F.filter(F.col("_lines"), lambda x: x.rlike(NOT_WORD_OR_SPACE))
    step = step.withColumns(
        {
            "_windows": window_hashes(F.col("_words")),
            "_worded": worded,
            "_kept": F.filter(F.col("_lines"), lambda x: line_fails(x, rules).isNull()),
        }
    )
    found = F.col("_windows")
    no_repeat = found.isNull() | (F.size(F.array_distinct(found)) == F.size(found))
    step = step.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(without(whole, SPACES)).cast("bigint"),
            "n_symbols": (F.length(whole) - F.length(without(whole, SYMBOLS))).cast("bigint"),
            "n_dup_lines": (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("bigint"),
            "n_repeat_words": F.when(no_repeat, F.lit(0).cast("bigint")).otherwise(covered(found)),
            "clean_text": F.array_join("_kept", "\n"),
            "n_lines_removed": (F.size("_lines") - F.size("_kept")).cast("bigint"),
        }
    )
    step = step.withColumns(
        {
            "base_failed": (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
            "lost_chars": F.col("word_chars") - F.length(without(F.col("clean_text"), SPACES)),
        }
    )
    kept = ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * rules.lost_percent)
    return step.withColumn("kept", kept & (F.col("lost_chars") < F.col("word_chars"))).drop(
        "_words", "_lines", "_windows", "_worded", "_kept"
    )
