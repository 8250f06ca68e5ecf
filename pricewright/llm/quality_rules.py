"""Quality rules: a threshold table compiled into Spark projections, evaluated without user functions.

Every metric is a column expression, every rule a bound on a ratio of two metrics.
Windows that occur twice are found by hashing the eight words of each window;
only documents in which a hash repeats sort their windows.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = 8

# Frequent function words of the languages the rules expect.
STOP_WORDS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with",
    "de": "auf das dem den der des die ein eine für im in ist mit nicht sich und von zu",
    "fr": "au avec dans de des du elle en est et la le les ne par pas pour que qui sur un une",
    "es": "al como con de del el en es la las lo los no para por que se su un una y",
}


class Rule(NamedTuple):
    """``low <= numerator / denominator <= high``; a zero denominator counts as one."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("shouting", "n_marks", "n_words", None, 0.3),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("echoes", "n_echoes", "n_words", None, 0.3),
)


def _windows(words: str, n: str) -> Column:
    return F.when(F.col(n) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.col(n) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))))


def _letters_of(text: str, pattern: str) -> Column:
    """Number of characters that match the class ``pattern``."""
    return F.length(F.regexp_replace(text, f"[^{pattern}]+", "")).cast("long")


def measured(docs: DataFrame, text_col: str = "text", carried: list[str] | None = None) -> DataFrame:
    """``__row`` (the ``carried`` columns, all by default, as one struct) and the metrics of the whole text."""
    stops = sorted({w for line in STOP_WORDS.values() for w in line.split()})
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in carried or docs.columns)).alias("__row"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    split = base.select("__row", "__text", F.array_remove(F.split("__text", r"[ \t\n\x0B\f\r]+"), "").alias("__words"),
                        F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]")).alias("__lines"))
    sized = split.select(
        "__row", "__words", "__lines", F.size("__words").alias("__n"),
        _letters_of("__text", r"#*$%&|<>").alias("n_symbols"), _letters_of("__text", r"!?").alias("n_marks"))
    hashed = sized.select(
        "__row", "__n", "n_symbols", "n_marks", _windows("__words", "__n").alias("__hashes"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("__words", lambda w: F.lower(w).isin(stops))).cast("long").alias("n_stop_words"),
        F.size(F.filter("__words", lambda w, i: w == F.get("__words", i - 1))).cast("long").alias("n_echoes"))
    ordered = hashed.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__hashes")) < F.size("__hashes"),
        F.sort_array(F.transform("__hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, i, step: F.coalesce(F.get("__sorted", i + step)["h"] == x["h"], F.lit(False))
    twice = ordered.withColumn("__at", F.sort_array(F.transform(
        F.filter("__sorted", lambda x, i: (F.when(i > 0, same(x, i, -1)).otherwise(False)) | same(x, i, 1)),
        lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("__at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    metrics = F.struct(
        F.col("__n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_marks", "n_lines", "n_stop_words", "n_echoes")
    # exploding an array of one keeps filters above it: pushed below the projections
    # they would evaluate the arrays anew for every element
    return twice.select("__row", F.explode(F.array(metrics)).alias("__metrics")).select("__row", "__metrics.*")


def base_failed() -> Column:
    """Too short, or mostly repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The threshold table as one boolean expression over the metrics; an empty table allows everything."""
    def bound(rule: Rule) -> Column:
        ratio = F.col(rule.numerator) / F.greatest(F.col(rule.denominator), F.lit(1))
        low = F.lit(True) if rule.low is None else ratio >= rule.low
        return low if rule.high is None else low & (ratio <= rule.high)
    return reduce(lambda a, b: a & b, map(bound, rules), F.lit(True))


def assessed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Metrics and verdict of every document: id, ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept``.

    Null and empty texts have no words, so they fail the base rule. Each row is
    judged alone: repeated rows and ties do not matter, a null id is carried along,
    an empty table gives no rows, other columns are not looked at.
    """
    return measured(docs, text_col, [id_col]).select(
        F.col("__row")[id_col].alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & compiled(rules)).alias("kept"))


def passing(docs: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with all their columns and nothing else."""
    return measured(docs, text_col).where(~base_failed() & compiled(rules)).select("__row.*")
