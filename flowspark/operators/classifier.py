"""Random-forest classification with MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.functions.labels import decode_prediction
from flowspark.operators.columns import computed_once
from flowspark.schema import LABEL, PREDICTED, quoted

INDEXED = "label_indexed"
VECTOR = "features"


def label_indexer(label: str = LABEL, handle_invalid: str = "error") -> StringIndexer:
    """Most frequent label first, ties in label order."""
    return StringIndexer(inputCol=label, outputCol=INDEXED, handleInvalid=handle_invalid)


def index_labels(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Frequency index of the label. Fitting brings the distinct labels to the driver,
    so it is meant for mapped classes, whose number the rules bound."""
    return label_indexer(label).fit(df).transform(df)


def feature_assembler(features: Sequence[str]) -> VectorAssembler:
    """Feature vector; rows with NULL or NaN are skipped, infinities pass."""
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="skip")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The feature vector beside the columns, each feature computed once."""
    return feature_assembler(features).transform(computed_once(df, features))


def forest_pipeline(
    features: Sequence[str],
    label: str = LABEL,
    num_trees: int = 20,
    max_depth: int = 5,
    seed: int = 42,
    feature_subset: str = "sqrt",
    handle_invalid: str = "error",
    max_memory_mb: int = 256,
) -> Pipeline:
    forest = RandomForestClassifier(
        labelCol=INDEXED,
        featuresCol=VECTOR,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        featureSubsetStrategy=feature_subset,
        maxMemoryInMB=max_memory_mb,
    )
    return Pipeline(
        stages=[label_indexer(label, handle_invalid), feature_assembler(features), forest]
    )


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str = LABEL,
    storage: StorageLevel | None = None,
    partitions: int | None = None,
    **params,
) -> PipelineModel:
    """Fit the pipeline. The forest keeps its own binned copy of the rows, so an input
    read from Parquet gains little from ``storage``; a computed one does."""
    df = df.select(*map(quoted, [*features, label]))
    if partitions:
        df = df.repartition(partitions)
    if storage is None:
        return forest_pipeline(features, label, **params).fit(df)
    df = df.persist(storage)
    try:
        return forest_pipeline(features, label, **params).fit(df)
    finally:
        df.unpersist()


def fitted_labels(model: PipelineModel) -> list[str]:
    """Class names in the order of the model's prediction index."""
    return list(model.stages[0].labels)


def with_predicted_class(
    df: DataFrame, labels: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    return df.withColumn(PREDICTED, decode_prediction(F.col(prediction), labels))


def score(
    model: PipelineModel,
    df: DataFrame,
    labels: Sequence[str] | None = None,
    skip_invalid: bool = True,
) -> DataFrame:
    """Score a batch or a stream and name the class. The label column may be missing.

    Rows with a NULL or NaN feature are skipped; with ``skip_invalid=False``, for cleaned
    rows, such a row is an error instead. Features are made once, before the test for
    NULLs, and the forest runs once, before any filter on the class.
    """
    if skip_invalid:
        df = computed_once(df, model.stages[1].getInputCols())
    else:
        checked = model.stages[1].copy().setHandleInvalid("error")
        model = PipelineModel([model.stages[0], checked, *model.stages[2:]])
    scored = model.transform(df)
    scored = computed_once(scored, ["prediction"])  # the rest stays prunable
    return with_predicted_class(scored, fitted_labels(model) if labels is None else labels)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importances(
    spark: SparkSession, model: PipelineModel, features: Sequence[str]
) -> DataFrame:
    """One row per feature, with the size of the forest."""
    forest = model.stages[-1]
    weights = forest.featureImportances.toArray()
    return spark.createDataFrame(
        [
            (name, float(weight), forest.getNumTrees, forest.totalNumNodes, forest.numClasses)
            for name, weight in zip(features, weights)
        ],
        "feature string, importance double, trees int, nodes int, classes int",
    )
