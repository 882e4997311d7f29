"""Quality rules over lines, then over documents; DataFrame functions only.

Each line of a text is judged by itself: symbol noise and menus (separators between few words),
shouting (an exclamation mark after every other word), stubs that neither end a sentence nor
hold enough words, and short boilerplate. Failing lines are removed; a document is kept if its
base figures pass and the lines left hold enough of its words.

A document is one row and stays where it is: no shuffle, no limit on its length. Repeated
three-word windows are found by sorting the windows' 64-bit hashes within the row, which takes
n log n steps for n words.

Nulls and blank texts have no words, so they fail the base rules and aren't kept; their cleaned
text is empty. Repeated rows are judged one by one. Other columns, whatever their names, are
neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import BLANK_CLASS, BLANKS, WORD_CLASS, free_name

# Phrases of page furniture; they count only in short lines.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in",
    "lorem ipsum",
    "privacy policy",
    "sign up",
    "subscribe to our newsletter",
    "terms of use",
)


@dataclass(frozen=True)
class Rules:
    """Thresholds; shares are in percent."""

    min_words: int = 50
    max_repeated_pct: int = 50
    max_symbols_per_100_words: int = 40
    max_shouts_per_100_words: int = 40
    max_boilerplate_words: int = 12
    min_open_line_words: int = 3
    max_lost_pct: int = 40


def words(text: Column) -> Column:
    """Array of words; a text without any gives an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_CLASS + "+"))


def chars_of(text: Column, kind: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, kind, ""))


def repeated_words(found: Column, sorted_windows: Column) -> Column:
    """Words in three-word windows that occur twice or more, from the (hash, place) pairs in order."""

    def twin(window: Column, i: Column) -> Column:
        before = F.get(sorted_windows, i - 1)["h"]
        after = F.get(sorted_windows, i + 1)["h"]
        return F.coalesce(window["h"] == before, F.lit(False)) | F.coalesce(window["h"] == after, F.lit(False))

    places = F.sort_array(F.transform(F.filter(sorted_windows, twin), lambda w: w["p"]))

    def covered(p: Column) -> Column:
        shared = F.zip_with(
            F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
            F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))),
            lambda b, a: F.greatest(F.lit(0), F.lit(3) - (b - a)).cast("long"),
        )
        return (F.lit(3) * F.size(p)).cast("long") - F.aggregate(shared, F.lit(0).cast("long"), lambda s, x: s + x)

    return F.when(F.size(found) < 4, F.lit(0).cast("long")).otherwise(_bound(places, covered))


def _bound(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def window_pairs(found: Column) -> Column:
    """(hash, place) of each three-word window, ordered by hash and place."""
    n = F.size(found)
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(
            F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("p")
        ),
    )
    return F.when(n >= 4, F.sort_array(pairs))


def line_fails(line: Column, rules: Rules) -> Column:
    """Whether a line is noise, a menu, shouting, a stub or boilerplate. Blank lines pass."""

    def verdict(n: Column) -> Column:
        noise = F.lit(100) * chars_of(line, r"[#*$%&|<>]") > F.lit(rules.max_symbols_per_100_words) * n
        shouting = F.lit(100) * chars_of(line, "!") > F.lit(rules.max_shouts_per_100_words) * n
        stub = (n < rules.min_open_line_words) & ~F.rlike(line, F.lit(r"[.!?:;,\"')\]]" + BLANK_CLASS + "*$"))
        boilerplate = (n <= rules.max_boilerplate_words) & F.rlike(
            line, F.lit("(?i)" + "|".join(BOILERPLATE))
        )
        return (n > 0) & (noise | (shouting & (n > 1)) | stub | boilerplate)

    return _bound(F.regexp_count(line, F.lit(WORD_CLASS)), verdict)


def judge(documents: DataFrame, text: str = "text", rules: Rules = Rules()) -> tuple[DataFrame, dict[str, str]]:
    """The documents with a verdict in added columns, and the names these got.

    Keys: ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed lost_words kept
    cleaned``; a name that the table already has is prefixed with underscores.
    """
    names: dict[str, str] = {}
    frame = documents

    def add(key: str, value: Column) -> None:
        nonlocal frame
        names[key] = free_name(frame, key)
        frame = frame.withColumn(names[key], value)

    def col(key: str) -> Column:
        return F.col(f"`{names[key]}`")

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    add("words", words(body))
    add("windows", window_pairs(col("words")))
    add("lines", F.split(body, "\n"))
    add("worded", F.filter(col("lines"), lambda x: F.rlike(x, F.lit(WORD_CLASS))))
    add("good", F.filter(col("lines"), lambda x: ~line_fails(x, rules)))
    add("cleaned", F.array_join(col("good"), "\n"))
    add("n_words", F.size(col("words")).cast("long"))
    add("word_chars", F.length(F.regexp_replace(body, BLANK_CLASS + "+", "")).cast("long"))
    add("n_symbols", chars_of(body, r"[#*$%&|<>]").cast("long"))
    add("n_dup_lines", (F.size(col("worded")) - F.size(F.array_distinct(col("worded")))).cast("long"))
    add("n_repeat_words", repeated_words(col("words"), col("windows")))
    add("lost_words", col("n_words") - F.regexp_count(col("cleaned"), F.lit(WORD_CLASS)))
    add(
        "base_failed",
        (col("n_words") < rules.min_words)
        | (F.lit(100) * col("n_repeat_words") > F.lit(rules.max_repeated_pct) * col("n_words")),
    )
    add(
        "kept",
        ~col("base_failed") & (F.lit(100) * col("lost_words") <= F.lit(rules.max_lost_pct) * col("n_words")),
    )
    return frame.drop(*(names.pop(k) for k in ("words", "windows", "lines", "worded", "good"))), names


def op10_quality_rules(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Figures and verdict per document."""
    judged, _ = judge(documents.select("doc_id", "text"), rules=rules)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "lost_words",
    )


def kept_documents(documents: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of the documents that pass, with the columns they came with and their text as it was."""
    judged, names = judge(documents, rules=rules)
    # A filter moves below the columns it needs by repeating their expressions, nested ones many times over;
    # it stays above an expression that depends on the partition.
    kept = F.col(f"`{names['kept']}`") & (F.spark_partition_id() >= 0)
    return judged.withColumn(names["kept"], kept).where(F.col(f"`{names['kept']}`")).select(*(F.col(f"`{c}`") for c in documents.columns))
