"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import only

# White space, symbols, and the most frequent words of the corpus languages.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a al an and as be by con das de dans del den der des die du el ein elle en er es et for from im in is it la "
    "las le les los mit no of on or ou par para pour que qui se sie su sur that the this to un una und was with y zu"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure must lie between ``least`` and ``most``; ``base`` rules make ``base_failed``."""

    measure: str
    least: float | None = None
    most: float | None = None
    base: bool = False

    def failed(self) -> Column:
        value = F.col(self.measure)
        below = F.lit(False) if self.least is None else value < self.least
        above = F.lit(False) if self.most is None else value > self.most
        return below | above


RULES = (
    Rule("n_words", least=50, base=True),
    Rule("repeat_percent", most=50, base=True),
    Rule("mean_word_length", least=2, most=14),
    Rule("symbol_percent", most=10),
    Rule("stop_word_percent", least=4),
    Rule("upper_percent", most=30),
    Rule("dup_line_percent", most=40),
)


def _share(part: str, whole: Column | str) -> Column:
    """100 * part / whole, 0 of nothing."""
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.coalesce(F.try_divide(F.col(part) * 100, whole), F.lit(0.0))


def measured(docs: DataFrame) -> DataFrame:
    """The counts and ratios that rules refer to, computed inside the row."""
    text = F.coalesce("text", F.lit(""))
    bare = F.translate(text, SPACE, "")
    start = docs.select(
        "doc_id",
        F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != "").alias("lines"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
    )
    word = lambda place: F.get("words", place)
    gram = lambda i: F.struct(F.xxhash64(word(i), word(i + 1), word(i + 2)).alias("h"), i.alias("p"))
    places = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3))
    grams = start.withColumn("grams", F.array_sort(F.transform(F.coalesce(places, F.array().cast("array<int>")), gram)))

    def repeated(gram: Column, i: Column) -> Column:
        beside = lambda j: F.coalesce(F.get("grams", j)["h"] == gram["h"], F.lit(False))
        return F.when(beside(i - 1) | beside(i + 1), F.array(gram["p"], gram["p"] + 1, gram["p"] + 2))

    covered = F.array_distinct(F.flatten(F.filter(F.transform("grams", repeated), lambda x: x.isNotNull())))
    stop = F.filter("words", lambda w: F.translate(F.lower(w), ".,;:!?", "").isin(STOP_WORDS))
    counted = grams.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_upper",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(covered).cast("long").alias("n_repeat_words"),
        F.size(stop).alias("n_stop_words"),
    )
    return counted.select(
        "*",
        _share("n_repeat_words", "n_words").alias("repeat_percent"),
        F.coalesce(F.try_divide("word_chars", "n_words"), F.lit(0.0)).alias("mean_word_length"),
        _share("n_symbols", "word_chars").alias("symbol_percent"),
        _share("n_stop_words", "n_words").alias("stop_word_percent"),
        _share("n_upper", "word_chars").alias("upper_percent"),
        _share("n_dup_lines", "n_lines").alias("dup_line_percent"),
    )


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs (doc_id, text)`` with its measures, ``base_failed``, ``failed`` and ``kept``.

    ``failed`` lists the measures out of bounds. Null and empty texts have no words and fail the least
    length. Repeated three-word runs are told by 64-bit fingerprints. Nothing leaves the row, so no group of
    rows meets anywhere; other columns are ignored.
    """
    measures = measured(only(docs, doc_id="long", text="string"))
    base = [r.failed() for r in rules if r.base]
    names = F.array_compact(F.array(*[F.when(r.failed(), F.lit(r.measure)) for r in rules]))
    failed = measures.withColumn("failed", names)
    any_base = F.lit(False)
    for condition in base:
        any_base = any_base | condition
    return failed.withColumn("base_failed", any_base).withColumn("kept", F.size("failed") == 0)
