"""Run SQL over a DataFrame through a temporary view (unique per call)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def sql_view_query(df: DataFrame, sql_template: str, view_param: str = "view") -> DataFrame:
    """``sql_template`` names the view as ``{view}``; Catalyst plans the SQL exactly
    like the DataFrame equivalent."""
    name = f"hearth_v_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql_template.format(**{view_param: name}))
