"""Indexed dataset format (SN1, S3, S4, S5), merge (SN2) and byte layout."""

import os
import struct

import numpy as np
from pyspark.sql import functions as F

from corpusloom.operators.merge import merge_binidx
from corpusloom.sources.binidx import read_binidx, write_binidx
from corpusloom.sources.checks import dataset_checks


def _write(spark, path, docs, dtype="uint16"):
    df = spark.createDataFrame([(0, i, ids, lens) for i, (ids, lens) in enumerate(docs)],
                               "part long, doc long, token_ids array<int>, sentence_lens array<int>")
    write_binidx(df.repartition(1).sortWithinPartitions("doc").select("part", "token_ids", "sentence_lens"),
                 path, dtype=dtype)
    return os.path.join(path, "part-000000000000000")


def test_golden_bytes_two_documents(spark, tmp):
    # documents [1,2] and [] in uint16: hand-written from the format table
    prefix = _write(spark, tmp, [([1, 2], [2]), ([], [])])
    idx = open(prefix + ".idx", "rb").read()
    expect = (b"MMIDIDX\x00\x00" + struct.pack("<Q", 1) + bytes([8]) + struct.pack("<QQ", 1, 3)
              + struct.pack("<i", 2) + struct.pack("<q", 0) + struct.pack("<qqq", 0, 1, 1))
    assert idx == expect
    assert open(prefix + ".bin", "rb").read() == bytes.fromhex("01000200")


def test_roundtrip_and_index_only(spark, tmp):
    prefix = _write(spark, tmp, [([1, 2, 3], [2, 1]), ([4], [1]), ([], []), ([5, 6], [2])])
    rows = read_binidx(spark, prefix).orderBy("seq_id").collect()
    assert [(r.seq_id, r.doc_id, r.sent_pos, r.tokens) for r in rows] == [
        (0, 0, 0, [1, 2]), (1, 0, 1, [3]), (2, 1, 0, [4]), (3, 3, 0, [5, 6])]
    assert [r.ptr for r in rows] == [0, 4, 6, 8]
    idx = read_binidx(spark, prefix, columns="index")
    assert "tokens" not in idx.columns and idx.count() == 4
    docs = read_binidx(spark, prefix, table="documents").orderBy("doc_id").collect()
    assert [(d.seq_begin, d.seq_end) for d in docs] == [(0, 2), (2, 3), (3, 3), (3, 4)]
    assert all(r.ok for r in dataset_checks(spark, prefix).collect())


def test_merge_two_parts(spark, tmp):
    a = _write(spark, os.path.join(tmp, "a"), [([1, 2], [2])])
    b = _write(spark, os.path.join(tmp, "b"), [([3], [1])])
    out = os.path.join(tmp, "merged")
    info = merge_binidx(spark, [a, b], out)
    assert info["sequences"] == 2
    rows = read_binidx(spark, out).orderBy("seq_id").collect()
    assert [r.tokens for r in rows] == [[1, 2], [3]]
    assert [r.ptr for r in rows] == [0, 4]
    assert [r.doc_id for r in rows] == [0, 1]


def test_float_and_range_check(spark, tmp):
    df = spark.createDataFrame([(0, [0.5, 1.5], [2])], "part long, token_ids array<float>, sentence_lens array<int>")
    write_binidx(df, os.path.join(tmp, "f"), dtype="float32")
    r = read_binidx(spark, os.path.join(tmp, "f")).first()
    assert r.tokens == [0.5, 1.5]
    bad = spark.createDataFrame([(0, [70000], [1])], "part long, token_ids array<int>, sentence_lens array<int>")
    try:
        write_binidx(bad, os.path.join(tmp, "bad"), dtype="uint16")
        raise AssertionError("expected a range error")
    except Exception as e:  # noqa: BLE001
        assert "out of range" in str(e)


def test_part_spanning_partitions_is_rejected(spark, tmp):
    df = spark.createDataFrame([(0, [1], [1]), (0, [2], [1])], "part long, token_ids array<int>, sentence_lens array<int>")
    try:
        write_binidx(df.repartition(2), os.path.join(tmp, "dup"))
        raise AssertionError("expected an error")
    except Exception as e:  # noqa: BLE001
        assert "two tasks" in str(e)


def test_multimodal_modes_roundtrip(spark, tmp):
    df = spark.createDataFrame([(0, [1, 2, 3], [2, 1], [1, 2]), (0, [4], [1], None)],
                               "part long, token_ids array<int>, sentence_lens array<int>, modes array<tinyint>")
    path = os.path.join(tmp, "mm")
    write_binidx(df.repartition(1), path, multimodal=True)
    rows = read_binidx(spark, path, multimodal=True).orderBy("seq_id").collect()
    assert [r.mode for r in rows] == [1, 2, 0]  # missing modes are zeros (Q23)
    # the header does not flag modes: a plain read sees the same sequences
    assert read_binidx(spark, path).count() == 3
