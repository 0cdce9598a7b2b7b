"""Session settings that fit wide flow rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The JVM compiles no method above 8000 bytes of byte code. Fused code over 78 columns
# is longer and would run interpreted; below this limit Spark splits it up instead.
HUGE_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
JIT_LIMIT = "8000"
SPARK_DEFAULT = "65535"


def tune(spark: SparkSession) -> SparkSession:
    """Keep wide projections compilable, unless the user chose a limit of their own."""
    if spark.conf.get(HUGE_METHOD_LIMIT, SPARK_DEFAULT) == SPARK_DEFAULT:
        spark.conf.set(HUGE_METHOD_LIMIT, JIT_LIMIT)
    return spark


def build_session(name: str) -> SparkSession:
    """Session of a job. Memory, cores and shuffle sizes are left to spark-submit."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC")
    return tune(builder.getOrCreate())


def with_settings(spark: SparkSession, settings: dict[str, object]) -> SparkSession:
    """A clone of the session with other SQL settings.

    It shares catalog, context and tables; what is planned or started in it sees the settings,
    and the session itself, which others may be using, keeps its own.
    """
    clone = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for name, value in settings.items():
        clone.conf.set(name, value)
    return clone


def in_session(df: DataFrame, session: SparkSession) -> DataFrame:
    """The same frame, planned and started under another session's settings."""
    plan = df._jdf.queryExecution().analyzed()
    rows = session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, plan)
    return DataFrame(rows, session)
