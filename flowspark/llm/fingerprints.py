"""Document fingerprints: Merkle trees over sections, paragraphs and spans of text.

A paragraph is a line. Its spans are the leaves: runs of text up to a sentence end, at most
120 characters long; their short digests measure likeness. Paragraphs are gathered into sections that end where a paragraph's hash
says so, so that an edit moves no section boundary but its own. From the paragraphs up,
every node is the SHA-256 of its children's; equal roots mean equal texts, and a comparison goes down only where
hashes differ. The fingerprint is the tree in writing: the root, then the leaves' digests,
8 digits each, with ``,`` between paragraphs and ``.`` between sections.

Cases: a NULL or empty text is one empty paragraph without leaves; two such trees are
alike by 1, one of them and any other by 0. Repeated rows have equal fingerprints. Further
columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowspark.llm.common import let

SPAN = r"[^.!?]{1,120}[.!?]*|[.!?]+"
SECTION_PARAGRAPHS = 8


def _above(hashes: Column) -> Column:
    """The hash of a node with these children."""
    return F.sha2(F.array_join(hashes, ""), 256)


def tree(text: Column) -> Column:
    """Struct of root and sections; sections have hash and paragraphs, these have leaves."""

    def paragraph(line: Column) -> Column:
        leaves = F.transform(
            F.regexp_extract_all(line, F.lit(SPAN), F.lit(0)), lambda span: F.xxhash64(span)
        )
        return let(
            leaves,
            lambda own: F.struct(F.sha2(line, 256).alias("hash"), own.alias("leaves")),
        )

    def sections(paragraphs: Column) -> Column:
        last = F.size(paragraphs)
        places = F.sequence(F.lit(1), last)
        ends = F.filter(
            places,
            lambda i: (i == last)
            | (F.pmod(F.xxhash64(F.get(paragraphs, i - 1)["hash"]), F.lit(SECTION_PARAGRAPHS)) == 0),
        )
        return let(
            ends,
            lambda stops: F.zip_with(
                F.concat(F.array(F.lit(0)), F.slice(stops, F.lit(1), F.size(stops) - 1)),
                stops,
                lambda start, stop: let(
                    F.slice(paragraphs, start + 1, stop - start),
                    lambda own: F.struct(
                        _above(F.transform(own, lambda p: p["hash"])).alias("hash"),
                        own.alias("paragraphs"),
                    ),
                ),
            ),
        )

    text = F.coalesce(text, F.lit(""))
    paragraphs = F.transform(F.split(text, "\n"), paragraph)
    return let(
        let(paragraphs, sections),
        lambda own: F.struct(
            _above(F.transform(own, lambda s: s["hash"])).alias("root"),
            own.alias("sections"),
        ),
    )


def leaves_of(node: Column) -> Column:
    """Distinct leaves of a tree."""
    paragraphs = F.flatten(F.transform(node["sections"], lambda s: s["paragraphs"]))
    return F.array_distinct(F.flatten(F.transform(paragraphs, lambda p: p["leaves"])))


def differing(left: Column, right: Column) -> Column:
    """Paragraphs (section, paragraph, both from 1) of ``left`` that ``right`` has not.

    Sections that both have are not looked into.
    """

    def paragraphs(section: Column, number: Column, known: Column) -> Column:
        return F.transform(
            F.filter(
                F.transform(
                    section["paragraphs"],
                    lambda p, j: F.named_struct(
                        F.lit("section"), number + 1, F.lit("paragraph"), j + 1,
                        F.lit("hash"), p["hash"],
                    ),
                ),
                lambda p: ~F.array_contains(known, p["hash"]),
            ),
            lambda p: F.named_struct(
                F.lit("section"), p["section"], F.lit("paragraph"), p["paragraph"]
            ),
        )

    def changed(known_sections: Column, known: Column) -> Column:
        return F.flatten(
            F.transform(
                left["sections"],
                lambda s, i: F.when(
                    F.array_contains(known_sections, s["hash"]),
                    F.array().cast("array<struct<section:int,paragraph:int>>"),
                ).otherwise(paragraphs(s, i, known)),
            )
        )

    theirs = F.flatten(F.transform(right["sections"], lambda s: s["paragraphs"]))
    return let(
        F.transform(right["sections"], lambda s: s["hash"]),
        lambda sections: let(
            F.transform(theirs, lambda p: p["hash"]), lambda known: changed(sections, known)
        ),
    )


def written(node: Column) -> Column:
    """The fingerprint of a tree as a string."""

    def digits(leaves: Column) -> Column:
        return F.array_join(
            F.transform(leaves, lambda h: F.lpad(F.hex(F.shiftrightunsigned(h, 32)), 8, "0")), ""
        )

    sections = F.transform(
        node["sections"],
        lambda s: F.array_join(F.transform(s["paragraphs"], lambda p: digits(p["leaves"])), ","),
    )
    return F.concat(node["root"], F.lit(":"), F.lower(F.array_join(sections, ".")))


def likeness(root: Column, leaves: Column, root2: Column, leaves2: Column) -> Column:
    """1 for equal roots, else the share of leaves that both trees have (Dice)."""
    both = F.size(F.array_intersect(leaves, leaves2)).cast("double")
    total = F.size(leaves) + F.size(leaves2)
    return F.when(root == root2, 1.0).when(total == 0, 1.0).otherwise(2.0 * both / total)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    return docs.select("doc_id", written(tree(docs["text"])).alias("fingerprint"))


NO_ID = -(1 << 63)
#: Text of a window's task, and the ranges of ids that one aggregate can tell apart.
BLOCK_BYTES = 64 << 20
MOST_BLOCKS = 10_000


def _edges_below(edges: list[int], value: Column, equal: bool) -> Column:
    """How many of the sorted edges are below ``value``, or equal to it too.

    First the group of about the square root of them is found, then the place inside.
    """
    if not edges:
        return F.lit(0)

    def literal(numbers: list[int]) -> str:
        return "array(" + ", ".join(f"bigint('{n}')" for n in numbers) + ")"

    size = math.isqrt(len(edges)) + 1
    groups = [edges[i : i + size] for i in range(0, len(edges), size)]
    firsts = F.expr(literal([group[0] for group in groups]))
    every = F.expr("array(" + ", ".join(map(literal, groups)) + ")")
    count = lambda of: F.size(
        F.filter(of, (lambda e: e <= value) if equal else (lambda e: e < value))
    )
    return let(
        count(firsts),
        lambda n: F.when(n == 0, 0).otherwise((n - 1) * size + count(F.get(every, n - 1))),
    )


def _with_next(spark: SparkSession, docs: DataFrame, blocks: int) -> DataFrame:
    """Every row with the text of the next one, by descending id, from the first to the last.

    The ids are cut into ranges of about equal numbers of rows. A range is one window; the
    first row of the range below, known from one small aggregate, is sent to it as well.
    Rows of one id are ordered by a hash of their text, and an id that fills several ranges
    is cut by that hash.
    """
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("doc")
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    bounds = docs.select(doc).agg(F.percentile_approx("doc", shares, 10_000)).first()[0]
    if bounds is None:
        bounds = []
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"], doc, F.xxhash64(text).alias("tie"), text.alias("text"))
    share = F.col("tie") / F.lit(2.0**64) + 0.5  # from 0 to 1
    below = _edges_below(bounds, F.col("doc"), False)
    equal = _edges_below(bounds, F.col("doc"), True) - below
    rows = rows.select("*", below.alias("below"), equal.alias("equal"))
    block = F.col("below") + F.least("equal", F.floor(share * (F.col("equal") + 1)).cast("int"))
    rows = rows.withColumn("block", block).drop("below", "equal")
    tops = sorted(
        rows.groupBy("block").agg(F.max(F.struct("doc", "tie")).alias("top")).collect()
    )
    above = [(t["block"], t["top"]["doc"], t["top"]["tie"], u["block"], i == len(tops) - 1)
             for i, (t, u) in enumerate(zip(tops, [*tops[1:], *tops[:1]]))]
    # One row for each block, so its size is bounded by their number.
    sent_to = F.broadcast(
        spark.createDataFrame(above, "block int, top long, top_tie long, to int, last boolean")
    )
    is_top = (F.col("doc") == F.col("top")) & (F.col("tie") == F.col("top_tie"))
    stays = F.struct(F.col("block").alias("block"), F.lit(False).alias("guest"))
    goes = F.struct(F.col("to").alias("block"), F.lit(True).alias("guest"))
    dealt = rows.join(sent_to, "block").select(
        "doc_id",
        "doc",
        "tie",
        "text",
        F.explode(F.when(is_top, F.array(stays, goes)).otherwise(F.array(stays))).alias("at"),
    )
    order = Window.partitionBy("at.block").orderBy("at.guest", F.desc("doc"), F.desc("tie"))
    return dealt.select(
        "doc_id", "text", "at", F.lead("text").over(order).alias("next_text")
    ).where("not at.guest")


def edited_fingerprints(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likenesses.

    The edited text has the last half of the code points replaced by as many from the start
    of the next row by descending id. One row alone is its own next one. The table is cut
    into ``blocks`` windows, by default as many as its texts fill ``BLOCK_BYTES``.
    """
    spark = docs.sparkSession
    if blocks is None:
        size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        # Several for each task: blocks are dealt by hash, and the tasks get about as many.
        tasks = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        blocks = min(MOST_BLOCKS, max(tasks, -(-size // BLOCK_BYTES)))
    paired = _with_next(spark, docs, blocks)
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), chars - half),
        F.substring(F.col("next_text"), F.lit(1), half),
    )
    # Trees are made once: a generator is not copied into the expressions above it.
    trees = paired.select(
        "doc_id",
        chars.cast("long").alias("n_chars"),
        F.inline(
            F.array(
                let(
                    edited,
                    lambda e: F.struct(
                        F.sha2(e, 256).alias("edited_sha256"),
                        tree(F.col("text")).alias("own"),
                        tree(e).alias("changed"),
                        tree(F.col("next_text")).alias("next"),
                    ),
                )
            )
        ),
    )
    leaves = trees.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"),
        F.size(differing(F.col("changed"), F.col("own"))).cast("long").alias("changed_paragraphs"),
        F.inline(
            F.array(
                F.struct(
                    F.col("own.root").alias("root"),
                    leaves_of(F.col("own")).alias("leaves"),
                    F.col("changed.root").alias("root2"),
                    leaves_of(F.col("changed")).alias("leaves2"),
                    F.col("next.root").alias("root3"),
                    leaves_of(F.col("next")).alias("leaves3"),
                )
            )
        ),
    )
    at = F.col
    return leaves.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(at("root"), at("leaves"), at("root2"), at("leaves2")).alias("near_edited"),
        likeness(at("root"), at("leaves"), at("root3"), at("leaves3")).alias("near_next"),
        "changed_paragraphs",
    )
