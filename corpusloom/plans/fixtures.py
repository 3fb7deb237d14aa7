"""Inputs the registered queries derive from the given tables with Spark.

Every fixture is written below the session's shared scratch folder and is a
deterministic function of the table it reads, so its size grows with the
table.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import prepare_session, release, scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Fixed value of the corpus fixture: documents per file bucket.
BUCKET_DOCS = 4096


def documents_jsonl(spark: SparkSession, sf_dir: str) -> str:
    """``documents`` as a JSONL corpus in nested folders
    ``lang=xx/bucket=k/part-*.jsonl`` with ``k = doc_id div 4096``: one file per
    (language, bucket), rows in ``doc_id`` order. Every group holds at most
    4096 documents, so no language becomes a hot partition. Line order of the
    corpus = sorted path, then ``doc_id``."""
    out = scratch_dir(spark, "documents-jsonl")
    docs = table(spark, sf_dir, "documents").withColumn("bucket", F.expr(f"doc_id div {BUCKET_DOCS}"))
    (docs.select(F.to_json(F.struct("doc_id", "text")).alias("value"), "lang", "bucket")
     .repartition("lang", "bucket").sortWithinPartitions("lang", "bucket", "doc_id")
     .write.mode("overwrite").partitionBy("lang", "bucket").text(out))
    rename_to_jsonl(spark, out)
    release(spark)  # the shuffled copy of all texts; after another query, as Spark holds on to the last one
    return out


def events_jsonl(spark: SparkSession, sf_dir: str) -> str:
    """Edge-case JSON lines built from ``events`` by a rule on ``event_id``
    (all rows kept, in event order):

    ====  =========================================  ===========
    m=8k  line                                       expected
    ====  =========================================  ===========
    0     {"text": "<event_type>", "p": <props>}      accepted
    1     {"text": ["<event_type>", "<user_id>"]}     accepted
    2     {"text": null, "v": <value>}                accepted, ""
    3     <props>  (no text key)                      accepted, ""
    4     <props><props>                              bad_json
    5     {"text": <user_id>}                         bad_type
    6     [<props>]                                   not_object
    7     <props> without its last character          bad_json
    ====  =========================================  ===========
    """
    out = scratch_dir(spark, "events-jsonl")
    ev = table(spark, sf_dir, "events")
    m = F.pmod(F.col("event_id"), F.lit(8))
    uid = F.col("user_id").cast("string")
    line = (F.when(m == 0, F.format_string('{"text": "%s", "p": %s}', "event_type", "props"))
            .when(m == 1, F.format_string('{"text": ["%s", "%s"]}', F.col("event_type"), uid))
            .when(m == 2, F.format_string('{"text": null, "v": %s}', F.col("value").cast("string")))
            .when(m == 3, F.col("props"))
            .when(m == 4, F.concat("props", "props"))
            .when(m == 5, F.format_string('{"text": %s}', uid))
            .when(m == 6, F.concat(F.lit("["), F.col("props"), F.lit("]")))
            .otherwise(F.expr("substring(props, 1, length(props) - 1)")))
    (ev.select("event_id", line.alias("value")).repartitionByRange(4, "event_id")
     .sortWithinPartitions("event_id").select("value").write.mode("overwrite").text(out))
    rename_to_jsonl(spark, out)
    return out


def rename_to_jsonl(spark: SparkSession, root: str) -> None:
    """Spark's text writer names files ``part-*.txt``; a corpus wants
    ``.jsonl``. Renamed through the Hadoop file system of the path, several
    files at a time."""
    from corpusloom.sources.corpus import _hadoop_fs, listed_files
    fs, _ = _hadoop_fs(spark, root)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    paths = [r.path for r in listed_files(spark, root, "part-*.txt").collect()]
    with ThreadPoolExecutor(16) as pool:
        done = list(pool.map(lambda p: fs.rename(new(p), new(p[:-4] + ".jsonl")), paths))
    if not all(done):
        raise OSError(f"{done.count(False)} files below {root} could not be renamed")
