"""Quality rules: a threshold table compiled into one projection of built-in functions.

Everything is measured on the words (runs of non-space characters) and lines of the whole
text. Cases: a NULL or empty text has no words and fails the base rule; a ratio without a
denominator counts as 0. Texts in none of the four languages of ``STOP_WORDS`` fail that rule; a
table for others is a parameter. Texts are judged alone, so repeated rows get equal results, and
further columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import SPACES, let, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not are this from or an at "
    "der die das und den von zu mit des auf für ist im dem nicht ein eine "
    "le la les et un une que est pour qui dans par sur au "
    "el los las y se del por con no su para es al lo como de en"
).split()


@dataclass(frozen=True)
class Rule:
    """``ratio`` (a SQL expression over the measures) has to lie in [least, most]."""

    name: str
    ratio: str
    least: float = float("-inf")
    most: float = float("inf")


RULES = (
    Rule("mean_word_chars", "word_chars / n_words", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols / n_words", most=0.2),
    Rule("stop_word_share", "n_stop_words / n_words", least=0.02),
    Rule("duplicate_line_share", "n_dup_lines / n_lines", most=0.5),
    Rule("short_line_words", "n_words / n_lines", least=2.0),
)


def _repeated_words(words: Column) -> Column:
    """Words inside a window of 8 that occurs twice or more in this text."""

    def neighbours(items: Column) -> Column:
        return F.slice(items, 2, F.size(items))

    def repeated_starts(windows: Column) -> Column:
        pairs = F.zip_with(
            windows,
            neighbours(windows),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
        )
        found = F.flatten(F.filter(pairs, lambda pair: pair.isNotNull()))
        return F.sort_array(F.array_distinct(found))

    def covered(starts: Column) -> Column:
        lengths = F.zip_with(
            starts, neighbours(starts), lambda x, y: F.coalesce(F.least(y - x, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(lengths, F.lit(0), lambda total, n: total + n)

    def windows(hashes: Column) -> Column:
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
                lambda i: F.struct(
                    F.xxhash64(F.slice(hashes, i, WINDOW)).alias("h"), i.alias("p")
                ),
            )
        )

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    found = let(let(hashes, windows), lambda w: let(repeated_starts(w), covered))
    return F.when(F.size(words) > WINDOW, found).otherwise(0)


def measures(text: Column) -> Column:
    """Struct of the counts that rules are written over."""
    text = F.coalesce(text, F.lit(""))
    wordy_lines = F.filter(
        F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0
    )

    def count(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, "")))
            .cast("long")
            .alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS)))
            .cast("long")
            .alias("n_stop_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    return let(words_of(text), lambda words: let(wordy_lines, lambda lines: count(words, lines)))


def compile_rules(rules: Sequence[Rule]) -> Column:
    """True where every ratio is inside its limits."""
    verdict = F.lit(True)
    for rule in rules:
        ratio = F.coalesce(F.expr(f"try_divide({rule.ratio.replace(' / ', ', ')})"), F.lit(0.0))
        if rule.least > float("-inf"):
            verdict = verdict & (ratio >= rule.least)
        if rule.most < float("inf"):
            verdict = verdict & (ratio <= rule.most)
    return verdict


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    min_words: int = 20,
    max_repeat_percent: int = 30,
) -> DataFrame:
    """doc_id, the measures, base_failed and kept; one row per row of ``docs``."""
    counted = docs.select("doc_id", measures(docs["text"]).alias("_m")).select("doc_id", "_m.*")
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & compile_rules(rules)).alias("kept"),
        "n_stop_words",
        "n_lines",
    )


def _sql_rules(rules: Sequence[Rule]) -> str:
    parts = []
    for rule in rules:
        over, under = rule.ratio.split(" / ")
        ratio = f"coalesce(CAST({over} AS DOUBLE) / nullif({under}, 0), 0)"
        if rule.least > float("-inf"):
            parts.append(f"{ratio} >= CAST({rule.least} AS DOUBLE)")
        if rule.most < float("inf"):
            parts.append(f"{ratio} <= CAST({rule.most} AS DOUBLE)")
    return " AND ".join(parts)


ORACLE_SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM texts)
), windows AS (
  SELECT doc_id, p, string_agg(word, ' ') OVER a AS body, count(*) OVER a AS n
  FROM words WINDOW a AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
), starts AS (
  SELECT doc_id, p FROM windows WHERE n = 8
  QUALIFY count(*) OVER (PARTITION BY doc_id, body) > 1
), spans AS (
  SELECT doc_id, least(8, coalesce(lead(p) OVER (PARTITION BY doc_id ORDER BY p) - p, 8)) AS n
  FROM starts
), repeats AS (SELECT doc_id, sum(n) AS n_repeat_words FROM spans GROUP BY doc_id),
counts AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars,
    count(*) FILTER (lower(word) IN ({", ".join(f"'{w}'" for w in STOP_WORDS)})) AS n_stop_words
  FROM words GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words,
    CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'gs')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_stop_words, 0) AS n_stop_words, coalesce(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN counts USING (doc_id) LEFT JOIN lines USING (doc_id)
    LEFT JOIN repeats USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT *, NOT base_failed AND {_sql_rules(RULES)} AS kept FROM judged
"""
