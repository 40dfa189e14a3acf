"""Quality rules: a table of thresholds compiled into one projection of text ratios.

Only built-in expressions are used, so the whole filter is a scan and a projection.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.shared import once, packed

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 5

#: Frequent function words of the languages in the collection.
STOP_WORDS = (
    "the of and to in a is that for it with as was on are by this be at from "
    "der die das und in den von zu mit ist des im ein eine nicht auf für sich "
    "le la les de des et un une du en dans que qui est pour pas par sur "
    "el los las del que y en un una se por con para"
).split()


#: As written, with a capital, and in capitals, so that texts need not be lowered.
STOP_FORMS = sorted({form for word in STOP_WORDS for form in (word, word.capitalize(), word.upper())})


class Rule(NamedTuple):
    """Rejects a text when the measure is below ``low`` or above ``high`` (None: no limit)."""

    measure: str
    low: float | None
    high: float | None


#: The default table. Ratios are between 0 and 1 but for lengths.
RULES = (
    Rule("mean_word_chars", 2.0, 14.0),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.3),
    Rule("mean_line_words", 2.0, None),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Two columns: ``row``, a struct of all input columns, and ``m``, a struct of counts and ratios.

    Null text counts as empty: no words, no lines, every count and ratio 0. Repeated rows are
    measured alike, and columns of any name are carried along. An empty table gives no rows.

    The steps are separate projections, so that no array is built twice for one row.
    """
    body = F.coalesce(F.col("_text"), F.lit(""))
    step = packed(docs).select("row", F.col("row")[text].alias("_text"))
    step = step.select(
        "row",
        (F.octet_length(body) - F.octet_length(F.regexp_replace(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.array_remove(F.split(body, SPACES), "").alias("words"),
        F.split(body, "\n").alias("lines"),
    )
    step = step.select(
        "row",
        "n_symbols",
        "words",
        # Lines with a word: something is left after cutting the spaces at both ends.
        F.filter("lines", lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")) != "").alias("lines"),
        # One hash for each window of five words.
        F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("words") - WINDOW),
                lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("grams"),
    )
    # Sorting (hash, place) puts equal windows side by side; texts without any are not sorted.
    step = step.select(
        "row",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.filter("words", lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("placed"),
    )
    beside = lambda x, k: (F.get("placed", k - 1)["h"] == x["h"]) | (F.get("placed", k + 1)["h"] == x["h"])
    places = F.sort_array(F.transform(F.filter("placed", beside), lambda x: x["i"]))
    # Each place of a repeated window adds the words up to the next such place, five at most.
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    step = step.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("placed")
    counts = [c for c in step.columns if c != "row"]
    ratios = F.struct(
        *counts,
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("word_chars")).alias("symbol_ratio"),
        _ratio(F.col("n_stop_words"), F.col("n_words")).alias("stop_word_ratio"),
        _ratio(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_ratio"),
        _ratio(F.col("n_words"), F.col("n_lines")).alias("mean_line_words"),
    )
    return once(step, ["row"], m=ratios)


def verdict(rules=RULES, measures: str = "m") -> Column:
    """True where a text passes every rule of the table."""
    passed = F.lit(True)
    for rule in rules:
        value = F.col(measures)[rule.measure]
        if rule.low is not None:
            passed = passed & (value >= F.lit(float(rule.low)))
        if rule.high is not None:
            passed = passed & (value <= F.lit(float(rule.high)))
    return passed


def judged(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``measured`` with two booleans: ``base_failed`` (fewer than ten words, or over a fifth of
    them inside repeated windows) and ``kept`` (neither that nor a failed rule of the table)."""
    m = F.col("m")
    failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    return measured(docs, text).withColumns({"base_failed": failed, "kept": ~failed & verdict(rules)})


def passing(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows that pass, with the columns of the input."""
    return judged(docs, text, rules).where("kept").select("row.*")
