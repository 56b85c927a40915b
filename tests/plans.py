"""Physical plans as text."""

from __future__ import annotations


def plan_of(df, mode: str = "formatted") -> str:
    utils = df.sparkSession.sparkContext._jvm.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), mode)
