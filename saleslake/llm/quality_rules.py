"""Line-first quality rules in DataFrame functions.

Every line is judged first: it fails if it holds no word, lacks closing punctuation while it is
short, is navigation (many separators and marks for its words), shouts (only capitals), or is
boilerplate. Failing lines are removed; a document that loses too much of its text is rejected, and
so is one that fails the base rules (too few words, or mostly repeated three-word windows).

Null and empty texts have no words: all counts are 0 and the base rules fail. Repeated rows are
judged alike. Windows are found by sorting those of one text, without a shuffle.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.tables import free_names

# Fixed values of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
SHORT_LINE_WORDS = 10
BOILERPLATE_LINE_WORDS = 30
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?…:;\"'”’»)"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BOILERPLATE = (
    "cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|click here|"
    "subscribe|sign in|sign up|log in|read more|powered by|share on"
)
ADDED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines",
    "n_removed_lines", "lost_chars", "cleaned", "kept",
]


def _without(value: Column, characters: str) -> Column:
    return F.translate(value, characters, "")


def _count(value: Column, characters: str) -> Column:
    return F.length(value) - F.length(_without(value, characters))


def _words(value: Column) -> Column:
    return F.filter(F.split(value, "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")


def line_fails(line: Column) -> Column:
    words = F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+"))
    closed = F.regexp_replace(line, "[\\x20\\x09-\\x0D]+$", "")
    unclosed = F.instr(F.lit(CLOSING), F.substring(closed, -1, 1)) == 0
    navigation = 4 * _count(line, SYMBOLS) > words
    shouts = (_count(line, LOWER) == 0) & (_count(line, UPPER) >= 10)
    boilerplate = (words < BOILERPLATE_LINE_WORDS) & F.lower(line).rlike(BOILERPLATE)
    return (words == 0) | (unclosed & (words < SHORT_LINE_WORDS)) | navigation | shouts | boilerplate


def apply_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts, the verdicts and the cleaned text."""
    # The input row travels as one struct, so no name of it can clash with a column of a step.
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    value = F.coalesce(F.col(f"_row.`{text}`"), F.lit(""))
    # One projection for each step: an argument used inside a lambda is computed once, in front.
    split = row.select(
        "_row", value.alias("_value"), _words(value).alias("_words"), F.split(value, "\n", -1).alias("_lines")
    )
    n = F.size("_words")
    window = lambda i: F.struct(
        F.concat_ws(" ", *[F.get("_words", i + k) for k in range(3)]).alias("w"), i.alias("at")
    )
    listed = split.select(
        "*",
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array()).alias("_windows"),
        F.filter("_lines", lambda line: ~line_fails(line)).alias("_kept_lines"),
        F.filter("_lines", lambda line: F.length(_without(line, SPACES)) > 0).alias("_full_lines"),
    )
    ordered = listed.select("*", F.sort_array("_windows").alias("_sorted"))
    same = lambda x, i: F.coalesce(x["w"] == F.get("_sorted", i)["w"], F.lit(False))
    repeated = ordered.select(
        "*",
        F.sort_array(
            F.transform(F.filter("_sorted", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"])
        ).alias("_at"),
    )
    steps = F.transform("_at", lambda x, i: F.coalesce(F.least(F.lit(3), F.get("_at", i + 1) - x), F.lit(3)))
    chars = F.length(_without(F.col("_value"), SPACES))
    counted = repeated.select(
        "_row",
        n.cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        _count(F.col("_value"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_full_lines") - F.size(F.array_distinct("_full_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept_lines")).cast("long").alias("n_removed_lines"),
        F.array_join("_kept_lines", "\n").alias("cleaned"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lost = F.col("word_chars") - F.length(_without(F.col("cleaned"), SPACES))
    judged = counted.withColumns({"base_failed": failed, "lost_chars": lost.cast("long")})
    enough = 100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars")
    kept = judged.withColumn("kept", ~F.col("base_failed") & enough)
    return kept.select("_row.*", *[F.col(c).alias(name) for c, name in zip(ADDED, free_names(df, *ADDED), strict=True)])
