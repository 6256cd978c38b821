"""Plan inspection helpers (what a user reads in ``explain``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    """The executed plan as text, after AQE has re-planned the stages.

    The DataFrame's own plan is run once (rows are counted in the executors,
    nothing is collected), so adaptive decisions - a runtime broadcast, a
    reused stage, a skew split - appear in the text.
    """
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def explain(df: DataFrame, mode: str = "formatted") -> str:
    """``df.explain(mode)`` as a string."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
