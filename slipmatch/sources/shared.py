"""Tables written once to the shared folder, so that later plans start from a scan."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slipmatch.session import shared_dir


class Written(NamedTuple):
    path: str
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def own_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_dir(spark)}/slipmatch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_aside(df: DataFrame, name: str, compression: str | None = None) -> Written:
    """``df`` as parquet below the shared folder, in a place of its own."""
    path = own_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return Written(path, df.schema)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder this package wrote, whatever file system it is on."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    return write_aside(df, name, compression).read(df.sparkSession)
