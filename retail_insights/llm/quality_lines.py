"""Line-first document cleaning, in DataFrame functions only.

Every line is judged on its own by punctuation, navigation and boilerplate
rules; failing lines are removed; a document that loses too much of its text
is rejected.  Word and repetition statistics of the whole text come with it.

All work on a document is done in its own row (array functions), so the
operator never shuffles and no key can be hot.

Defined results: a null text counts as empty; an empty text has no words and
fails the base rules; repeated rows are judged one by one; other columns of
the input (clashing names included) are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_insights.llm.common import WS_CHARS, WS_CLASS, only

# The symbols that are counted, and the base thresholds.
SYMBOL_CLASS = "[#*$%&|<>]"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5

# Line rules.  They use substring tests and character counts, and a document
# whose whole text cannot fail a rule skips it for its lines.
#: A prose line ends like a sentence; a closing quote or bracket may follow.
STOPS = [".", "!", "?", ":", ";", ",", "…", "。", "！", "？"]
ENDINGS = STOPS + [s + c for s in STOPS for c in ["\"", "'", "”", "’", "»", ")", "]", " ", "\r"]]
#: Shouting: so many doubled exclamation marks in one line.
MIN_SHOUTS = 5
#: Symbol noise: so many symbols, and one for so many characters.
MIN_LINE_SYMBOLS, SYMBOL_PER = 6, 12
#: Menus: so many separators, and one for so many characters.
SEPARATOR_CLASS = "[|»›•]"
MAX_MENU_LINE = 30
MIN_SEPARATORS, SEPARATOR_PER = 3, 30
MENU_LINES = ["home", "menu", "sign in", "log in", "login", "sign up", "subscribe", "next", "previous",
              "back to top", "read more", "share this", "skip to content"]
BOILERPLATE = ["lorem ipsum", "all rights reserved", "enable javascript", "javascript is required",
               "javascript is disabled", "uses cookies", "use cookies", "cookie policy", "privacy policy",
               "terms of use", "terms of service", "licensed under", "released under",
               "general public license", "copyright (c)"]
#: Each phrase above holds one of these, so a text without them needs no look at its lines.
BOILERPLATE_STEMS = ["lorem ipsum", "reserved", "javascript", "cookie", "policy", "terms of",
                     "licens", "released under", "copyright"]
#: A line that has a sentence end inside is prose even if its own end is cut off.
INNER_STOPS = [". ", "! ", "? ", "。"]
#: Another line without a sentence end fails from this many words on.
MIN_UNENDED_WORDS = 4
#: A document is kept if its remaining lines hold at least this share of its word characters.
MIN_KEPT_PCT = 20


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, WS_CLASS + "+"), "")


def _without_space(text: Column) -> Column:
    return F.length(F.translate(text, WS_CHARS, ""))


def _count(text: Column, char_class: str) -> Column:
    return F.size(F.split(text, char_class)) - 1


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _line_fails(line: Column) -> Column:
    """Cheap tests first: ``|`` between them stops at the first that holds.
    ``n_symbols``, ``n_separators``, ``shouts`` and ``boiler`` describe the document."""
    unended = ~_any([line.endswith(e) for e in ENDINGS]) & ~_any([line.contains(e) for e in INNER_STOPS]) & (
        F.size(F.split(F.trim(line), WS_CLASS + "+")) >= MIN_UNENDED_WORDS)
    low = F.lower(line)
    shout = F.col("shouts") & (
        F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit(""))) >= 2 * MIN_SHOUTS)
    noise = (F.col("n_symbols") >= MIN_LINE_SYMBOLS) & (_count(line, SYMBOL_CLASS) >= MIN_LINE_SYMBOLS) & (
        _count(line, SYMBOL_CLASS) * SYMBOL_PER >= F.length(line))
    menu = (F.col("n_separators") >= MIN_SEPARATORS) & (_count(line, SEPARATOR_CLASS) >= MIN_SEPARATORS) & (
        _count(line, SEPARATOR_CLASS) * SEPARATOR_PER >= F.length(line))
    entry = (F.length(line) <= MAX_MENU_LINE) & F.trim(low, F.lit(" \t\r.:>")).isin(*MENU_LINES)
    boiler = F.col("boiler") & _any([low.contains(p) for p in BOILERPLATE])
    return unended | shout | noise | menu | entry | boiler


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_kept_pct: int = MIN_KEPT_PCT) -> DataFrame:
    """One row per input row: id, the word and repetition statistics,
    ``base_failed``, ``kept``, ``n_lines``, ``n_bad_lines``, ``bad_chars`` and
    ``clean_text`` (the text without its failing lines).

    Five-word windows are compared by 64-bit hash within one text.
    """
    d = only(docs, id_col, text_col).select(
        F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    low = F.lower("text")
    d = d.select(
        id_col, _words(F.col("text")).alias("w"), F.split("text", "\n").alias("lines"),
        _count(F.col("text"), SYMBOL_CLASS).alias("n_symbols"),
        _count(F.col("text"), SEPARATOR_CLASS).alias("n_separators"),
        F.contains("text", F.lit("!!")).alias("shouts"),
        _any([F.contains(low, F.lit(p)) for p in BOILERPLATE_STEMS]).alias("boiler"))
    d = d.select(
        id_col, "n_symbols", "n_separators", "shouts", "boiler", F.size("w").alias("n"),
        F.length(F.concat_ws("", "w")).cast("long").alias("word_chars"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("wh"),
        F.filter("lines", lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("worded"))
    n_windows = F.greatest(F.col("n") - (WINDOW - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("wh", k + 1, n_windows) for k in range(WINDOW)])
    d = d.select(
        "*",
        F.sort_array(F.transform(zipped, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i")))).alias("s"),
        F.filter("worded", lambda x: ~_line_fails(x)).alias("good"))
    # A window found twice has an equal neighbour in the sorted list.
    marked = F.transform(
        "s", lambda x, k: F.when((F.get("s", k - 1)["h"] == x["h"]) | (F.get("s", k + 1)["h"] == x["h"]), x["i"]))
    d = d.select("*", F.sort_array(F.array_compact(marked)).alias("p"))
    covered = F.aggregate(
        "p", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
        lambda a: a["n"])
    d = d.select(
        F.col(id_col),
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("worded").cast("long").alias("n_lines"),
        (F.size("worded") - F.size("good")).cast("long").alias("n_bad_lines"),
        F.array_join("good", "\n").alias("clean_text"))
    kept_chars = _without_space(F.col("clean_text")).cast("long")
    d = d.withColumn("bad_chars", F.when(F.col("n_bad_lines") > 0, F.col("word_chars") - kept_chars)
                     .otherwise(F.lit(0).cast("long")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    kept = ~F.col("base_failed") & (
        (F.col("word_chars") - F.col("bad_chars")) * 100 >= F.col("word_chars") * min_kept_pct)
    return d.withColumn("base_failed", base_failed).withColumn("kept", kept).select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_bad_lines", "bad_chars", "clean_text")


def op1_quality_rules(spark, sf_dir):
    from retail_insights.llm.common import table
    return line_quality(table(spark, sf_dir, "documents")).drop("clean_text")
