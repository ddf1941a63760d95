"""The folder all executors share."""
from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the cluster's checkpoint folder.

    Only a local master may do without one, as in tests on one machine; a temporary folder is then taken.
    """
    context = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/millrace-{uuid.uuid4().hex}"


def local_frame(spark: SparkSession, rows: list[dict], schema: str | T.StructType) -> DataFrame:
    """A few rows held by the driver as a DataFrame that needs no Python worker."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], fields)
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(fields)), fields)


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without overriding what is configured."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
