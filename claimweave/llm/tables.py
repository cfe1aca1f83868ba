"""Written intermediate tables and small column helpers shared by the operators."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.session import shared_folder


class Scratch:
    """One folder per run below the shared folder; every table in it is written once."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._count = 0

    def cut(self, frame: DataFrame) -> DataFrame:
        """Write ``frame`` as Parquet and read it back: lineage ends, columns are recomputed never."""
        path = f"{self.root}/{self._count:03d}"
        self._count += 1
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, wanted: str) -> str:
    """A column name like ``wanted`` that ``frame`` does not have, in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def quoted(name: str) -> Column:
    """Column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
