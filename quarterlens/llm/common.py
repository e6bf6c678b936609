"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlens.session import ensure_checkpoint_dir

#: A word everywhere in this subpackage: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage with files that outlive any executor; unlike an RDD
    checkpoint the table is columnar, so later steps read only what they use.
    """
    path = shared_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """The tables of a job's steps in the shared folder, removed as soon as no later step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, []

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        """``materialize``, remembered for ``drop``."""
        path = shared_folder(self.spark, tag)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables of ``write``; whatever was read from them must have been written by now."""
        jvm = self.spark._jvm
        for i in [i for i, (df, _) in enumerate(self._paths) if any(df is t for t in tables)][::-1]:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(i)[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text):
    """Number of words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
