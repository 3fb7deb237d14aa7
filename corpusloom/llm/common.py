"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.plans.fixtures import table as _table
from corpusloom.session import checkpoint, prepare_session, release, scratch_dir

__all__ = ["checkpoint", "discard", "extend_schema", "fresh", "prepare", "read_table", "release", "stored", "text_key"]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: Arrow batches are bounded by rows and
    by bytes, so that one batch of very long texts stays small."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return _table(spark, sf_dir, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it (Spark compares
    column names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def extend_schema(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t) for n, t in fields)])


def text_key(text: Column) -> Column:
    """64-bit hash that, with ``doc_id``, names a row: rows with equal ``doc_id``
    and equal text are one document for every operator here."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def stored(df: DataFrame, shuffled: bool = True) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back:
    cuts the lineage as a checkpoint does, with columns and compression.
    A plan that is not ``shuffled`` leaves no shuffle files to release."""
    spark, schema, path = df.sparkSession, df.schema, scratch_dir(df.sparkSession, "llm")
    if shuffled:
        release(spark)
    df.write.mode("overwrite").parquet(path)
    if shuffled:
        release(spark)
    out = spark.read.schema(schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table behind a ``stored`` DataFrame that nothing reads any more."""
    spark, path = df.sparkSession, df._stored_path
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
