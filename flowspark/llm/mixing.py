"""Mixing sources to target weights: exact token budgets cut from a hash-random order.

Sources take the repeating weights in code-point order, NULL last, and share all tokens
(words here). A target stops at ``max_epochs`` times its source; what is above is shared
again by weight. Of a budget, whole epochs go to every document; the rest goes to the first
documents in the order of a hash of their ids and texts, and the last of them is cut to the word.

Rows of equal id and text are interchangeable and are one row with a count until the end. The
hash order is range-partitioned: a source's hash space is cut into equal ranges of about
``range_rows`` documents each, so a source with a third of all rows is many ranges, and so
are rows that share an id or have none. Tokens are summed for each range, the sums are added
up over a source's ranges, and inside a range documents are sorted. Only ids, sizes and hashes
take part.

Cases: a NULL or empty text has size 0 and is taken 0 words; NULL is a source of its own;
sources without a word have target 0. Repeated rows count each, one after the other. An empty table gives no rows. Further columns are kept
by ``mix_documents`` and left out by ``mixing``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import let, saved, words_of
from flowspark.operators.numbering import number_rows

WEIGHTS = (5, 2, 1)
HASH_RANGE = 1 << 32


def _row_key(docs: DataFrame) -> list[Column]:
    return [
        docs["doc_id"].cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("text_hash"),
    ]


def _known(value: Column) -> Column:
    """A text that tells NULL from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def targets(sized: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, source_rows, source_size, target) of every source."""
    totals = saved(
        sized.groupBy("source").agg(
            F.count(F.lit(1)).alias("source_rows"),
            F.sum(F.col("size") * F.col("copies")).alias("source_size"),
        ),
        "sources",
    )
    place = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*map(F.lit, weights)), place).cast("long")
    known = saved(
        number_rows(totals, "source", "place").withColumn("weight", weight), "weights"
    )
    capped = F.lit(False)
    least = max_epochs * F.col("source_size")
    before = -1
    while True:
        state = known.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(capped, least)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("open"),
            F.count(F.when(capped, 1)).alias("n"),
        ).first()
        if state["n"] == before or not state["open"]:
            break
        before = state["n"]
        share = (
            F.lit(float(state["all"] - state["fixed"])) * F.col("weight") / F.lit(state["open"])
        )
        capped = share >= least
    if not state["open"]:
        share = least.cast("double")
    return known.select(
        "source",
        "source_rows",
        "source_size",
        F.when(capped, least.cast("double")).otherwise(share).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = 3,
    range_rows: int = 4096,
) -> DataFrame:
    """doc_id, text_hash, size, source_size, target and taken of every row."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text_digest = F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    sized = saved(
        docs.select(
            *_row_key(docs),
            docs["source"].cast("string").alias("source"),
            F.size(words_of(docs["text"])).cast("long").alias("size"),
            text_digest.alias("digest"),
        )
        .withColumn("random", F.md5(F.concat(F.lit("mix:"), doc, F.lit(":"), "digest")))
        .groupBy("doc_id", "text_hash", "source", "size", "random")
        .agg(F.count(F.lit(1)).alias("copies")),
        "sizes",
    )
    shares = targets(sized, weights, max_epochs)
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    shares = saved(
        shares.withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
        .withColumn("ranges", F.ceil(F.col("source_rows") / range_rows)),
        "shares",
    )
    place = F.conv(F.substring("random", 1, 8), 16, 10).cast("long")
    ranged = (
        sized.withColumnRenamed("source", "of")
        .join(shares, F.col("of").eqNullSafe(F.col("source")))
        .withColumn("range", F.floor(place * F.col("ranges") / F.lit(HASH_RANGE)))
        .withColumn("of", _known(F.col("source")))
    )
    earlier = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("of", "range")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("in_range"))
        .select("of", "range", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)).alias("start"))
    )
    inside = (
        Window.partitionBy("of", "range")
        .orderBy("random", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = F.sum(F.col("size") * F.col("copies")).over(inside)
    placed = ranged.join(starts, ["of", "range"]).withColumn(
        "before", F.col("start") + F.coalesce(sizes, F.lit(0))
    )
    before = F.col("before") + (F.col("copy") - 1) * F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    return placed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "doc_id",
        "text_hash",
        "source",
        "copy",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixing(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row."""
    return mix(docs, **settings).drop("text_hash", "source", "copy")


def numbered_copies(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows numbered from 1 among those of equal keys, many copies in many tasks.

    Each part of the scan numbers its own; the counts of the parts before are added. The rows
    have to come straight from files, whose parts are the same in every attempt.
    """
    parts = rows.withColumn("_part", F.spark_partition_id())
    counts = saved(parts.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n")), "copies")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = saved(
        counts.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .where("_start > 0")
        .select(*keys, "_part", "_start"),
        "copies",
    )
    own = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(F.lit(1)))
    numbered = parts.withColumn("_own", own).join(starts, [*keys, "_part"], "left")
    return numbered.withColumn(column, F.col("_own") + F.coalesce("_start", F.lit(0))).drop(
        "_part", "_own", "_start"
    )


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row as often as it is taken, the columns of ``docs``.

    A document that a budget cuts has its first words, joined by single spaces, in its
    last row; ``n_chars`` follows if present.
    """
    taken = mix(docs, **settings).where("taken > 0")
    _, text = _row_key(docs)
    keys = ["_doc", "_text", "_of"]
    rows = docs.select(
        _known(docs["doc_id"].cast("long")).alias("_doc"),
        text.alias("_text"),
        _known(docs["source"]).alias("_of"),
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs["text"].alias("_whole"),
    )
    # Equal rows are told apart by number, so that each gets one of their shares.
    rows = numbered_copies(rows, keys, "_n")
    shares = taken.select(
        _known(F.col("doc_id")).alias("_doc"),
        F.col("text_hash").alias("_text"),
        _known(F.col("source")).alias("_of"),
        F.col("copy").cast("long").alias("_n"),
        "size",
        "taken",
    )
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    repeated = rows.join(shares, [*keys, "_n"]).select(
        "_row", "_whole", "size", "taken", F.explode(F.sequence(F.lit(1), times)).alias("_time")
    )
    left = F.col("taken") - (F.col("_time") - 1) * F.col("size")
    cut = let(
        words_of(F.col("_whole")), lambda w: F.array_join(F.slice(w, F.lit(1), left.cast("int")), " ")
    )
    text = F.when(left >= F.col("size"), F.col("_whole")).otherwise(cut)
    made = repeated.select("_row", text.alias("_new"))
    new = {"text": F.col("_new"), "n_chars": F.char_length("_new").cast("long")}
    return made.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('mix:' || doc_id || ':' || md5(coalesce(text, ''))) AS random
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS place
  FROM sources
), stages AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
        ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS free,
    CAST(sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      AS BIGINT) AS open
  FROM ranked
), level AS (
  SELECT free, open, place FROM stages WHERE free * weight / open < 3 * source_size
  ORDER BY place LIMIT 1
), shares AS (
  SELECT s.source, s.source_size,
    CASE WHEN l.place IS NULL OR s.place < l.place THEN CAST(3 * s.source_size AS DOUBLE)
      ELSE l.free * s.weight / l.open END AS target
  FROM ranked s LEFT JOIN level l ON true
), cuts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(floor(target) / source_size) AS BIGINT)
    ELSE 0 END AS epochs FROM shares
)
SELECT doc_id, size, source_size, target,
  epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size
    - CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY random, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))) AS taken
FROM sized d JOIN cuts c ON d.source IS NOT DISTINCT FROM c.source
"""
