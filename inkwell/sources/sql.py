"""SRC-5: parameterised SQL over the article table.

Parameters are bound by Spark (named ``:name`` markers), never formatted into
the text, so values cannot change the statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def article_sql(spark: SparkSession, text: str, args: dict | None = None,
                views: dict[str, DataFrame] | None = None) -> DataFrame:
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or None)
