"""Text statistics as Spark expressions (no Python on the executors)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words are runs of other characters than space and 0x09-0x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
UPPER = r"[A-Z]"
DIGIT = r"[0-9]"
BANG = r"[!?]"
SMALL_SET = 32              # repeated windows up to which each is looked up by a scan


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_chars(text: Column, pattern: str) -> Column:
    """How many characters of ``text`` match the class."""
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def duplicate_lines(lines: Column) -> Column:
    """Lines that equal an earlier one, of lines with a word."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def window_hashes(words: Column) -> Column:
    """64-bit hashes of the 3-word windows, in order."""
    third = F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0)))
    return F.transform(third, lambda w, i: F.xxhash64(F.get(words, i), F.get(words, i + 1), w))


def repeated_values(values: Column) -> Column:
    """Values that a sorted array holds twice or more."""
    return F.array_distinct(F.filter(values, lambda x, i: x == F.get(values, i - 1)))


def places_of(windows: Column, repeated: Column) -> Column:
    """Places (from 0, rising) of the windows that are repeated.  Few repeated
    windows are looked up one by one; many by a sort of (hash, place), so the
    work is n log n for any text."""
    few = F.array_compact(F.transform(windows, lambda x, i: F.when(F.array_contains(repeated, x), i)))

    def many(s: Column) -> Column:
        n = F.size(s)
        same = F.transform(s, lambda a, i: (a["h"] == F.get(s, i - 1)["h"]) | (a["h"] == F.get(s, F.when(i + 1 < n, i + 1).otherwise(-1))["h"]))
        return F.sort_array(F.array_compact(F.zip_with(s, same, lambda a, f: F.when(F.coalesce(f, F.lit(False)), a["i"]))))

    by_sort = bind(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), many)
    return F.when(F.size(repeated) == 0, F.array().cast("array<int>")).when(F.size(repeated) <= SMALL_SET, few).otherwise(by_sort)


def covered_words(places: Column) -> Column:
    """Distinct words of the 3-word windows at these rising places."""
    gaps = F.transform(places, lambda p, i: F.least(p - F.coalesce(F.get(places, i - 1), p - 3), F.lit(3)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)


def text_statistics(docs: DataFrame, windows: bool = True, keep: dict[str, Column] | None = None) -> DataFrame:
    """doc_id and counts of every whole text (null: none): n_words, n_chars (code points),
    word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words (null without
    ``windows``), n_upper, n_digits, n_bangs, n_distinct_words (all long), text_key
    (a hash of the text), and the columns ``keep`` of the document.

    n_repeat_words counts the words covered by 3-word windows that the text has
    twice or more; windows are compared by 64-bit hashes.
    """
    keep = keep or {}
    t = F.col("t")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"), *(c.alias(n) for n, c in keep.items()))
    counted = base.select(
        "doc_id", *keep,
        F.length("t").cast("long").alias("n_chars"),
        F.xxhash64("t").alias("text_key"),
        count_chars(t, SYMBOL).alias("n_symbols"),
        count_chars(t, UPPER).alias("n_upper"),
        count_chars(t, DIGIT).alias("n_digits"),
        count_chars(t, BANG).alias("n_bangs"),
        F.split(t, "\n", -1).alias("lines"),
        words_of(t).alias("words"))
    numbers = ["n_chars", "text_key", "n_symbols", "n_upper", "n_digits", "n_bangs"]
    counted = counted.withColumn("own", F.filter("lines", lambda x: x.rlike(HAS_WORD))).select(
        "doc_id", *keep, *numbers, "words", duplicate_lines(F.col("own")).alias("n_dup_lines"), F.size("lines").cast("long").alias("n_lines"))
    numbers += ["n_dup_lines", "n_lines", "n_words", "n_distinct_words", "word_chars"]
    w = F.col("words")
    measured = counted.select("*", F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
                              F.length(F.array_join(w, "")).cast("long").alias("word_chars"))
    if not windows:
        return measured.select("doc_id", *keep, *numbers, F.lit(None).cast("long").alias("n_repeat_words"))
    d = measured.select("doc_id", *keep, *numbers, window_hashes(w).alias("windows"))
    d = d.withColumn("sorted", F.sort_array("windows")).withColumn("repeated", repeated_values(F.col("sorted")))
    d = d.withColumn("places", places_of(F.col("windows"), F.col("repeated")))
    return d.select("doc_id", *keep, *numbers, covered_words(F.col("places")).alias("n_repeat_words"))


def rates(s: DataFrame) -> dict[str, Column]:
    """Scale-free measures of a row of statistics, 0 for an empty text."""
    w = F.greatest(F.col("n_words"), F.lit(1))
    c = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / w,
        "symbols": F.col("n_symbols") / w,
        "upper": F.col("n_upper") / c,
        "digits": F.col("n_digits") / c,
        "bangs": F.col("n_bangs") / w,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / w,
        "words_a_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "distinct": F.col("n_distinct_words") / w,
    }
