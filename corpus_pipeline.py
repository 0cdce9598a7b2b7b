"""Documents to packed training sequences: five stages, each over all that the one before kept.

Rejected documents go, lines that documents share stay in the first of them, one document
of each group of near copies stays, the sources are mixed to their target weights (a
document may appear several times, the one at a budget's end shortened), and the mix is
packed into sequences. Near copies are those of the SimHash operator: fingerprints of
three-word shingles that differ in at most three bits.

Cases: a NULL text is read as an empty one by every stage. A row without an id is a row like
any other; it is kept instead of near copies only if they have no id either. Rows equal in id
and text are near copies, so one of them stays, and ties are broken by the text's hash. An
empty table gives no rows; without a label to learn from the classifier keeps every row. Further columns go along up to the mix, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowspark.llm import line_dedup, mixing, packing, quality_classifier, simhash
from flowspark.llm.common import table
from flowspark.scratch import release, result


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packing(docs)


STAGES = [
    ("quality_classifier", classifier_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# SQL has neither the trained classifier nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage made on its way is deleted once its rows are written,
    and those once the next stage's are."""
    docs = documents = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        docs = result(spark, name, lambda stage=stage, docs=before: stage(spark, docs, sf_dir))
        if before is not documents:
            release(before)
    return docs
