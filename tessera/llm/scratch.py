"""Tables that an operator writes between its steps, in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


class Scratch:
    """Writes tables as Parquet under ``spark.checkpoint.dir`` and reads them back: a reliable cut of
    lineage that any executor can read again after a loss."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Deletes a written table that nothing reads any more."""
        for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            self._delete(f)

    def clear(self) -> None:
        """Deletes all tables written here, once nothing reads them any more."""
        self._delete(self.folder)

    def _delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
