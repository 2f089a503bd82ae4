"""Line-first cleaning: lines fail by punctuation, navigation and boilerplate rules, failing
lines go, then documents that lose too much text go. Spark SQL functions only; one scan, no
shuffle, a row at a time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Phrases of notices and page furniture, lower case.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under",
    "is licensed under",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use of cookies",
    "enable javascript",
    "click here",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "share this article",
    "skip to content",
    "lorem ipsum",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; counts are of code points, shares are percent."""

    bars: int = 3  # navigation: this many | and ...
    bar_percent: int = 4  # ... this share of the line
    symbol_percent: int = 8  # punctuation: more of # * $ % & < >
    shout_percent: int = 8  # punctuation: more of !
    shouts: int = 4  # ... and at least as many
    unended: int = 400  # punctuation: this long without any end mark
    notice: int = 200  # boilerplate: notices are no longer
    lost_percent: int = 50  # documents that lose more of their word characters go
    min_words: int = 10
    repeat_percent: int = 20


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column, rules: Rules = Rules(), phrases: Sequence[str] = BOILERPLATE) -> Column:
    """Whether a line with a word in it fails a rule."""
    size = F.length(line)
    bars, shouts = _count(line, "|"), _count(line, "!")
    navigation = (bars >= rules.bars) & (bars * 100 >= size * rules.bar_percent)
    punctuation = (
        (_count(line, "#*$%&<>") * 100 > size * rules.symbol_percent)
        | ((shouts >= rules.shouts) & (shouts * 100 > size * rules.shout_percent))
        | ((size >= rules.unended) & ~line.rlike("[.!?…]"))
    )
    boilerplate = F.lit(False)
    low = F.lower(line)
    for phrase in phrases:
        boilerplate = boilerplate | F.contains(low, F.lit(phrase))
    return navigation | punctuation | ((size <= rules.notice) & boilerplate)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``__repeat``: words of ``__words`` in five-word windows found twice or more."""
    window = F.when(
        F.size("__words") >= 5,
        F.expr(
            "transform(sequence(0, size(__words) - 5), i -> xxhash64("
            + ", ".join(f"__words[i + {k}]" for k in range(5))
            + "))"
        ),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))
    df = df.withColumn("__window", window)
    again = F.size(F.array_distinct("__window")) < F.size("__window")
    none = "cast(array() as array<struct<h: bigint, i: int>>)"
    df = df.withColumn(
        "__sorted",
        F.when(
            again, F.expr("sort_array(transform(__window, (x, i) -> struct(x AS h, i AS i)))")
        ).otherwise(F.expr(none)),
    ).drop("__window")
    # places of windows equal to a neighbour in hash order, in reading order
    df = df.withColumn(
        "__places",
        F.expr(
            """sort_array(filter(transform(__sorted, (s, k) -> if(
                 s.h = get(__sorted, k - 1).h OR s.h = get(__sorted, k + 1).h, s.i, NULL)),
               p -> p IS NOT NULL))"""
        ),
    )
    return df.withColumn(
        "__repeat",
        F.expr(
            """aggregate(transform(__places, (p, k) ->
                 cast(least(5, coalesce(get(__places, k + 1) - p, 5)) AS bigint)),
               0L, (total, n) -> total + n)"""
        ),
    ).drop("__sorted", "__places")


def clean_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    rules: Rules = Rules(),
    phrases: Sequence[str] = BOILERPLATE,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``cleaned`` (its text without failing
    lines), counts of the whole text, ``base_failed`` and ``kept``.

    ``n_words`` and ``word_chars`` (code points in words), ``n_symbols`` (``#*$%&|<>``),
    ``n_dup_lines`` (lines with a word that equal an earlier line), ``n_repeat_words`` (words
    in five-word windows found twice or more, the first included), ``n_lines`` (lines with a
    word), ``n_failed_lines`` and ``kept_chars`` (code points in words of the lines left).

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` of the
    words repeat. ``kept`` is false if that holds, or if the lines removed held more than
    ``lost_percent`` of the word characters.

    A null text counts as empty; a text without words fails. Ids may be null or repeat: every
    row is judged alone. Other columns, whatever their names, are not read.
    """
    df = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text")
    )
    df = df.withColumns(
        {
            "__words": F.filter(F.split("__text", SPACE, -1), lambda w: w != ""),
            "__lines": F.split("__text", "\n", -1),
        }
    )
    df = _repeat_words(df)
    has_word = F.filter("__lines", lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    df = df.withColumn("__live", has_word)
    df = df.withColumn("__left", F.filter("__live", lambda line: ~line_fails(line, rules, phrases)))
    df = df.withColumn("cleaned", F.array_join("__left", "\n"))
    df = df.select(
        "doc_id",
        "cleaned",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", WHITE, "")).cast("long").alias("word_chars"),
        _count(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__live") - F.size(F.array_distinct("__live"))).cast("long").alias("n_dup_lines"),
        F.col("__repeat").alias("n_repeat_words"),
        F.size("__live").cast("long").alias("n_lines"),
        (F.size("__live") - F.size("__left")).cast("long").alias("n_failed_lines"),
        F.length(F.translate("cleaned", WHITE, "")).cast("long").alias("kept_chars"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.repeat_percent
    )
    lost = (F.col("word_chars") - F.col("kept_chars")) * 100 > (
        F.col("word_chars") * rules.lost_percent
    )
    return df.withColumns({"base_failed": failed, "kept": ~failed & ~lost})
