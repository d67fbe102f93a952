"""Quality rules: a table of thresholds compiled into Spark column expressions.

Measures of length, symbols, stop words, lines and repeated word windows are computed with
built-in functions, row by row: no user function, no shuffle, no state across rows. A
:class:`Rule` bounds the ratio of two measures. :func:`compile_rules` turns a table of rules
into one Boolean column, :func:`failed_rules` into the names of those a text breaks.

A word is a maximal run of characters other than space and U+0009 to U+000D. A window is five
words in a row; windows are compared as texts, not by hash.

Defined cases: a null text counts as an empty one, has no words and fails the base rules. Every
row is judged for itself, so repeated rows and repeated or null ids give one row each. An empty
table gives an empty result. Whole texts are measured, whatever their length; a task holds the
words and windows of one text at a time. Only the id and the text are read, so other columns
may have any name; ``extra`` carries them along unless they clash with a measure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Frequent function words of English, Spanish, French and German.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from or an have not you "
    "de la que el en y los las se del un por con no una su para es al lo "
    "le et les des du une est dans qui pas sur au ou il ne ce pour par avec "
    "der die und den von zu das sich mit auf für ist im nicht dem ein eine als auch"
).split()
#: Marks that may close a word without being part of it.
CLOSING = ".,;:!?"


@dataclass(frozen=True)
class Rule:
    """``low <= part / whole <= high``, judged where ``whole`` is at least ``least``."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None
    least: int = 1


#: Thresholds. A ratio over few words or lines says little: ``least`` leaves such texts alone.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=3.0, high=10.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05, least=20),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.3, least=10),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9, least=5),
    Rule("cut_lines", "n_cut_lines", "n_lines", high=0.3, least=5),
)
MEASURES = (
    "n_words word_chars n_symbols n_stop_words n_lines n_dup_lines n_bullet_lines n_cut_lines "
    "n_repeat_words"
).split()


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def _is_stop_word(word: Column) -> Column:
    listed = STOP_WORDS + [w.capitalize() for w in STOP_WORDS]
    return F.rtrim(word, F.lit(CLOSING)).isin(listed)


def _stop_words(words: Column) -> Column:
    return F.size(F.filter(words, _is_stop_word))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside windows that the text holds at least twice.

    Windows are sorted only where a text holds equal ones. Each step is a projection of its
    own, so that no step is evaluated again for every element of the next one's arrays.
    """
    count = F.size("__words")

    def window(i: Column) -> Column:
        return F.concat_ws(" ", *[F.get("__words", i + k) for k in range(WINDOW)])

    windows = F.when(count > WINDOW, F.transform(F.sequence(F.lit(0), count - WINDOW), window))
    df = df.withColumn("__windows", windows)
    placed = F.sort_array(
        F.transform("__windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    )
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    df = df.withColumn("__sorted", F.when(some, placed)).drop("__windows")

    def neighbour(i: Column) -> Column:
        return F.get(F.col("__sorted"), i)["w"]

    def repeated(x: Column, i: Column) -> Column:
        no = F.lit(False)
        return F.coalesce(neighbour(i - 1) == x["w"], no) | F.coalesce(
            neighbour(i + 1) == x["w"], no
        )

    starts = F.sort_array(F.transform(F.filter("__sorted", repeated), lambda x: x["i"]))
    df = df.withColumn("__starts", starts).drop("__sorted")

    def newly_covered(at: Column, i: Column) -> Column:
        return F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("__starts"), i + 1) - at, F.lit(WINDOW)))

    covered = F.aggregate(
        F.transform("__starts", newly_covered), F.lit(0), lambda total, x: total + x
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "__starts"
    )


def measure(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", extra: Sequence[str] = ()
) -> DataFrame:
    """Id, ``extra`` columns and all measures of every row, as longs."""
    clash = {*MEASURES} & {id_column, *extra}
    if clash:
        raise ValueError(f"columns named like a measure: {sorted(clash)}")
    body = F.coalesce(F.col(text), F.lit(""))
    carried = [id_column, *(c for c in dict.fromkeys(extra) if c != id_column)]
    held = F.struct(*[F.col(c) for c in carried]).alias("__row")
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_SPACE))
    df = docs.select(
        held,
        _words(body).alias("__words"),
        lines.alias("__lines"),
        F.length(F.regexp_replace(body, f"{SPACE}+", "")).alias("word_chars"),
        F.length(F.regexp_replace(body, SYMBOLS, "")).alias("n_symbols"),
    )

    def lines_like(pattern: str) -> Column:
        return F.size(F.filter("__lines", lambda line: line.rlike(pattern)))

    df = df.select(
        "__row",
        "__words",
        "word_chars",
        "n_symbols",
        F.size("__words").alias("n_words"),
        _stop_words(F.col("__words")).alias("n_stop_words"),
        F.size("__lines").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
        lines_like(rf"\A{SPACE}*[-*•]").alias("n_bullet_lines"),
        lines_like(rf"(\.\.\.|…){SPACE}*\z").alias("n_cut_lines"),
    )
    df = _with_repeats(df)
    return df.select("__row.*", *[F.col(m).cast("long").alias(m) for m in MEASURES])


def base_failed() -> Column:
    """Too short, or too many words inside repeated windows."""
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    return (F.col("n_words") < MIN_WORDS) | repeats


def _broken(rule: Rule) -> Column:
    part, whole = F.col(rule.part), F.col(rule.whole)
    bounds = []
    if rule.low is not None:
        bounds.append(part < F.lit(rule.low) * whole)
    if rule.high is not None:
        bounds.append(part > F.lit(rule.high) * whole)
    return (whole >= rule.least) & reduce(Column.__or__, bounds, F.lit(False))


def compile_rules(rules: Sequence[Rule] = RULES) -> Column:
    """True where no rule is broken."""
    return ~reduce(Column.__or__, [_broken(r) for r in rules], F.lit(False))


def failed_rules(rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules that are broken, in the order of the table."""
    names = [F.when(_broken(r), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def judge(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_column: str = "doc_id",
    text: str = "text",
    extra: Sequence[str] = (),
) -> DataFrame:
    """Measures of every row with ``base_failed``, ``failed_rules`` and ``kept``."""
    measured = measure(docs, id_column, text, extra)
    return measured.withColumns(
        {
            "base_failed": base_failed(),
            "failed_rules": failed_rules(rules),
            "kept": ~base_failed() & compile_rules(rules),
        }
    )
