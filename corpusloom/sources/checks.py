"""Dataset existence and integrity checks (S5) as a DataFrame.

One row per (dataset prefix, check). The checks run in Spark tasks, one per
prefix, reading only the index: files present, header magic/version, the
document index ending at the sequence count, ``sum(length) * itemsize`` equal
to the ``.bin`` size (our addition) and pointers equal to the exclusive
prefix sum of the lengths.
"""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from corpusloom.sources.binidx import _index_arrays, list_prefixes, read_header

BLOCK = 1 << 20  # sequences looked at together
CHECKS = ["files", "header", "doc_index_end", "bin_size", "pointers"]


def _check(prefix: str) -> list[tuple]:
    rows = []
    present = os.path.exists(prefix + ".idx") and os.path.exists(prefix + ".bin")
    rows.append((prefix, "files", present))
    try:
        h = read_header(prefix)
        rows.append((prefix, "header", True))
    except Exception:  # noqa: BLE001
        rows.append((prefix, "header", False))
        return rows + [(prefix, c, False) for c in CHECKS[2:]]
    lengths, pointers, doc_idx, _ = _index_arrays(prefix, h, False)
    rows.append((prefix, "doc_index_end", bool(h.n_doc_idx > 0 and int(doc_idx[-1]) == h.n_seq)))
    total, right = 0, True
    for a in range(0, h.n_seq, BLOCK):  # in blocks: memory does not follow the number of sequences
        size = np.array(lengths[a:a + BLOCK], dtype=np.int64) * h.itemsize
        ends = total + np.cumsum(size)
        right = right and bool(np.array_equal(np.array(pointers[a:a + BLOCK], dtype=np.int64), ends - size))
        total = int(ends[-1])
    rows.append((prefix, "bin_size", present and total == h.bin_size))
    rows.append((prefix, "pointers", right))
    return rows


def dataset_checks(spark: SparkSession, path: str) -> DataFrame:
    from corpusloom.session import prepare_session
    prepare_session(spark)
    prefixes = list_prefixes(path)
    df = spark.createDataFrame([(p,) for p in prefixes], "prefix string").repartition(max(1, len(prefixes)))

    def run(batches):
        for b in batches:
            yield pd.DataFrame([r for p in b["prefix"] for r in _check(p)], columns=["prefix", "check", "ok"])

    return df.mapInPandas(run, "prefix string, check string, ok boolean")
