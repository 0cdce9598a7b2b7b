"""Line dedup: lines that several documents share stay in the first of them only.

Lines are normalised and hashed where they are read; only hashes, never line texts, are
grouped and joined. The smallest and the largest document of a hash tell whether it is
shared, so counting needs no distinct set and combines before its shuffle. Whole texts are
shuffled once, to be put together again by position.

Cases: a NULL or empty text is one empty line. Rows of one ``doc_id`` are one document, so
repeated rows are not cleared against each other; rows without ``doc_id`` are one document
that comes after all others. Further columns are kept (``dedup_lines``) or left out
(``line_dedup``), whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import SPACES, let, lower_ascii, saved

NO_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _row_key(docs: DataFrame) -> list[Column]:
    """Rows that agree in both have one text, hence one result."""
    text = F.coalesce(docs["text"], F.lit(""))
    return [
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("_doc"),
        F.xxhash64(text).alias("_text"),
    ]


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """(_doc, _text, _dropped): 0-based positions of the lines each row loses."""
    keyed = docs.select(
        *_row_key(docs), F.posexplode(lines_of(docs["text"])).alias("_position", "_line")
    )
    # Two independent 64-bit hashes; one alone would meet by chance among 10^10 lines.
    key = line_key(F.col("_line"))
    hashed = keyed.where(F.char_length(key) >= min_chars).select(
        "_doc",
        "_text",
        "_position",
        F.xxhash64(key).alias("_h1"),
        F.xxhash64(F.lit(7), key).alias("_h2"),
    )
    if min_documents == 2:
        counts = hashed.groupBy("_h1", "_h2").agg(
            F.min("_doc").alias("_first"), F.max("_doc").alias("_last")
        )
        shared = counts.where("_first < _last")
    else:
        counts = (
            hashed.select("_h1", "_h2", "_doc")
            .distinct()
            .groupBy("_h1", "_h2")
            .agg(F.min("_doc").alias("_first"), F.count(F.lit(1)).alias("_documents"))
        )
        shared = counts.where(F.col("_documents") >= min_documents)
    # Written first, so that both sides of the join come straight from a shuffle and Spark
    # can split the rows of a line that very many documents share.
    shared = saved(shared.select("_h1", "_h2", "_first"), "shared-lines")
    return (
        hashed.join(shared, ["_h1", "_h2"])
        .where("_doc > _first")
        .groupBy("_doc", "_text")
        .agg(F.collect_set("_position").alias("_dropped"))
    )


def _kept_text(text: Column, dropped: Column) -> Column:
    """The text without the lines at these positions."""
    def rest(lines: Column) -> Column:
        positions = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(positions, lambda i: F.get(lines, i)), "\n")

    return F.when(dropped.isNull(), text).otherwise(let(lines_of(text), rest))


def _with_dropped(docs: DataFrame, row: Column, **limits) -> DataFrame:
    doc, text = _row_key(docs)
    rows = docs.select(doc, text, row.alias("_row"), docs["text"].alias("_whole"))
    return rows.join(dropped_lines(docs, **limits), ["_doc", "_text"], "left")


def dedup_lines(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the shared lines taken out of ``text``; ``n_chars`` follows if present."""
    joined = _with_dropped(docs, F.struct(*[docs[c] for c in docs.columns]), **limits)
    new_text = _kept_text(F.col("_whole"), F.col("_dropped"))
    joined = joined.select("_row", new_text.alias("_new"))
    new = {"text": F.col("_new"), "n_chars": F.char_length("_new").cast("long")}
    return joined.select(
        *[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns]
    )


def line_dedup(docs: DataFrame, **limits) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256 of what is left of its text."""
    joined = _with_dropped(docs, docs["doc_id"], **limits)
    text = F.coalesce(F.col("_whole"), F.lit(""))
    return joined.select(
        F.col("_row").alias("doc_id"),
        F.size(lines_of(text)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept_text(text, F.col("_dropped")), 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS position, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
)
SELECT doc_id, count(*) AS n_lines,
  count(*) FILTER (doc_id > first_doc) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position)
    FILTER (first_doc IS NULL OR doc_id = first_doc), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""
