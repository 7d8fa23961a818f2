"""Schema signatures: recorded with a model, checked before scoring."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def signature(df: DataFrame) -> str:
    """Column names and types as JSON, to store next to a model."""
    return json.dumps([{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema])


def signature_report(df: DataFrame, recorded: str) -> DataFrame:
    """Each recorded column with its recorded and present type, and whether they agree."""
    present = dict(df.dtypes)
    rows = [(c["name"], c["type"], present.get(c["name"])) for c in json.loads(recorded)]
    report = df.sparkSession.createDataFrame(rows, "column_name string, recorded string, present string")
    return report.withColumn("matches", F.col("recorded").eqNullSafe(F.col("present")))


def check_signature(df: DataFrame, expected: StructType) -> None:
    """Raise unless the frame has every expected column with its type; further columns are fine."""
    present = dict(df.dtypes)
    wrong = {f.name: present.get(f.name) for f in expected if present.get(f.name) != f.dataType.simpleString()}
    if wrong:
        raise TypeError(f"input does not match the recorded signature: {wrong}")
