"""End-to-end corpus build (U2): corpus → parsed records → sentences →
token ids → one indexed dataset per JSON key.

Plan shape (``partitions == 1``): scan (S1/S2) → parse (P1-P4) → split
(P5-P7) → encode (T*, P8/P9, A1) → write one ``.bin``/``.idx`` part per input
split (SN1). Everything after the scan is narrow: token arrays never cross a
shuffle; only the per-split line counts of S2 do. With ``partitions > 1`` the
reference's partition files are reproduced as an order: R1/R2 assign a part
to every line, and each input split writes its lines of each part, whose names
follow the merged order (R3). A corpus of few splits takes one range shuffle of
its text. Optionally the parts are merged into a single file (SN2).
"""

from __future__ import annotations

import glob
import os

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.base import encode_documents
from corpusloom.operators import parse, partition, text
from corpusloom.operators.index import optimal_dtype
from corpusloom.operators.merge import cut_pieces, gather_table, merge_binidx, remove_parts
from corpusloom.operators.parallel import target_partitions
from corpusloom.session import checkpoint, prepare_session, release
from corpusloom.sources.binidx import read_header, write_binidx
from corpusloom.sources.catalogue import catalogue_of
from corpusloom.sources.corpus import read_lines, read_parquet_corpus
from corpusloom.spec import CorpusSpec

SUB_PARTS = 10 ** 6    # tasks that may write to one reference partition
PART_SPACE = 10 ** 12  # part ids of key k live in [k * PART_SPACE, (k + 1) * PART_SPACE)


def classify_columns(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Parquet columns as the JSON keys are read: a string is one sentence, a
    list of strings several, null an empty one; a list with a null, or a column
    of another type that is not null, is ``bad_type``. ``value`` holds the keys
    as JSON, for the quarantine."""
    texts, bad = [], F.lit(False)
    for k in keys:
        kind, col = lines.schema[k].dataType, F.col(f"`{k}`")
        if isinstance(kind, T.StringType):
            texts.append(F.array(F.coalesce(col, F.lit(""))))
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            texts.append(F.coalesce(col, F.array(F.lit(""))))
            bad = bad | F.coalesce(F.exists(col, lambda x: x.isNull()), F.lit(False))
        else:
            texts.append(F.array(F.lit("")))
            bad = bad | col.isNotNull()
    rest = [c for c in lines.columns if c not in keys and c != "value"]
    return lines.select(*rest, F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys])).alias("value"),
                        F.when(bad, "bad_type").alias("reason"), *[t.cast("array<string>").alias(k) for t, k in zip(texts, keys)])


def input_bytes(spark: SparkSession, path: str) -> int:
    from corpusloom.sources.corpus import _hadoop_fs
    fs, root = _hadoop_fs(spark, path)
    return fs.getContentSummary(root).getLength()


def input_splits(spark: SparkSession, path: str) -> int:
    """About as many scan splits as the input has, from its size alone (no plan
    is run to find out)."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m").strip().lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(size[-1:], 0)
    return input_bytes(spark, path) // (int(size.rstrip("kmgt")) << unit)


def part_room(spark: SparkSession, spec: CorpusSpec) -> int:
    """Part ids that each reference partition has: one for every line, when each input
    split writes its lines of each partition (enough splits for all cores, and fewer
    bytes than ids), or one a task, when a shuffle deals the lines out."""
    room = PART_SPACE // spec.partitions
    narrow = input_splits(spark, spec.input) >= spark.sparkContext.defaultParallelism and input_bytes(spark, spec.input) < room
    return room if narrow else SUB_PARTS


def prepared_records(spark: SparkSession, spec: CorpusSpec) -> tuple[DataFrame, DataFrame]:
    """``(classified lines, records(line_id, part, key_idx, sentences))``."""
    keys = list(spec.json_keys)
    if spec.input_format == "parquet":
        lines = read_parquet_corpus(spark, spec.input)
        cls = classify_columns(lines, keys)
    else:
        lines = read_lines(spark, spec.input)
        cls = parse.classify(lines, keys)
    ok = cls.where(F.col("reason").isNull())
    if spec.partitions > 1:
        # R1/R2 + R3: lines in merged order (part, line).
        # R2 counts every line, accepted or not
        parted = (partition.sequential(ok, spec.partitions, n_lines=lines.count()) if spec.keep_sequential_samples
                  else partition.round_robin(ok, spec.partitions))
    if spec.partitions > 1 and (room := part_room(spark, spec)) != SUB_PARTS:
        # each split writes its lines of each partition, no shuffle; the splits'
        # first lines order what they wrote
        part = F.col("part_id") * room + F.col("split_line0")
    elif spec.partitions > 1:
        # one range shuffle of the text puts every task on a contiguous run of that order
        tasks = max(spec.partitions, target_partitions(parted))
        if tasks >= SUB_PARTS:
            raise ValueError(f"{tasks} tasks for one build; part ids leave room for {SUB_PARTS}")
        parted = parted.repartitionByRange(tasks, "part_id", "line_id")
        # unmerged: one output dataset per reference partition, written by several tasks
        part = (F.spark_partition_id() if spec.merge_partitions
                else F.col("part_id") * SUB_PARTS + F.spark_partition_id())
    elif spec.per_file or input_splits(spark, spec.input) >= target_partitions(ok):
        # enough input splits (or per-file outputs): each split is one
        # output part, no shuffle
        parted, part = ok, F.col("split_line0")
    else:
        # few large splits: spread the text by line range over all cores
        parted, part = ok.repartitionByRange(target_partitions(ok), "line_id"), F.spark_partition_id()
    items = ", ".join(f"{i}, `{k}`" for i, k in enumerate(keys))
    order = F.col("part_id") if spec.partitions > 1 else F.lit(0)
    fkey = (partition.file_key("file_path", spec.input) if spec.per_file else F.lit(None)).cast("string")
    recs = parted.select("line_id", part.cast("long").alias("part"), order.cast("long").alias("ord"),
                         fkey.alias("fkey"),
                         F.expr(f"stack({len(keys)}, {items}) as (key_idx, sentences)"))
    if spec.split_sentences:
        recs = recs.withColumn("sentences", text.split_values(F.col("sentences"), spec.keep_newlines,
                                                              abbreviations=spec.abbreviations or None))
    return cls, recs


def input_fingerprint(spark: SparkSession, spec: CorpusSpec) -> str:
    """Fingerprint of the input files (path, size, modification time,
    from Spark's file listing, summed in Spark), of the job parameters and of the contents
    of the tokenizer's files."""
    import hashlib
    import json
    from corpusloom.sources.corpus import listed_files
    h = hashlib.sha256(json.dumps({k: str(v) for k, v in sorted(spec.__dict__.items())}).encode())
    tok = spec.tokenizer
    for path in (tok.vocab_file, tok.merges_file, tok.tokenizer_model):
        for name in sorted(_files_of(path)):
            with open(name, "rb") as f:
                h.update(repr((name, hashlib.file_digest(f, "sha256").hexdigest())).encode())
    each = [F.xxhash64(F.lit(k), "path", "length", "modificationTime") for k in range(2)]
    sums = listed_files(spark, spec.input).agg(F.count(F.lit(1)), *[F.sum(x.cast("decimal(38,0)")) for x in each], *map(F.bit_xor, each))
    h.update(repr(tuple(sums.first())).encode())
    return h.hexdigest()


def _files_of(path: str | None) -> list[str]:
    if not path or not os.path.exists(path):
        return []
    if os.path.isfile(path):
        return [path]
    return [os.path.join(d, n) for d, _, names in os.walk(path) for n in names]


def build_corpus(spark: SparkSession, spec: CorpusSpec, resume: bool = True) -> dict:
    """The whole build. With ``resume``, a finished build whose manifest
    carries the same input fingerprint is returned without recomputation
    (the reference reuses stale partition files even if the input changed;
    Q14 fixed)."""
    import json
    prepare_session(spark)
    manifest = spec.output_prefix + "__manifest.json"
    fp = input_fingerprint(spark, spec)
    if resume and os.path.exists(manifest):
        with open(manifest, encoding="utf-8") as f:
            done = json.load(f)
        if done.get("fingerprint") == fp and all(map(_complete, _outputs(spec, done["result"]))):
            return done["result"]
    result = _build(spark, spec)
    with open(manifest + ".tmp", "w", encoding="utf-8") as f:
        json.dump({"fingerprint": fp, "result": result}, f)
    os.replace(manifest + ".tmp", manifest)  # written last: marks the build complete
    return result


def _outputs(spec: CorpusSpec, result: dict) -> list[str]:
    """Dataset prefixes (or folders of datasets) that a build has written."""
    return list(result["files"].values()) if spec.per_file else [result[k] for k in spec.json_keys]


def _complete(output: str) -> bool:
    """Both files of a dataset are there, with the sizes that its header gives."""
    from corpusloom.sources.binidx import list_prefixes
    prefixes = list_prefixes(output) if os.path.isdir(output) else [output]
    for p in prefixes:
        try:
            h = read_header(p)
        except (OSError, ValueError):
            return False
        if h.bin_size < 0 or os.path.getsize(p + ".idx") < 34 + 12 * h.n_seq + 8 * h.n_doc_idx:
            return False
    return bool(prefixes)


def _build(spark: SparkSession, spec: CorpusSpec) -> dict:
    tok = spec.tokenizer.build()
    dtype = spec.dtype or optimal_dtype(tok.vocab_size)
    cls, recs = prepared_records(spark, spec)
    obs = Observation("encode_stats")
    # rows of a part are already in one task (input split or range partition); texts
    # are put in order, which are a quarter of their ids
    recs = recs.sortWithinPartitions("key_idx", "part", "ord", "line_id")
    enc = encode_documents(recs, tok, "sentences", keep=["line_id", "part", "ord", "key_idx", "fkey"],
                           append_eod=spec.append_eod)
    enc = enc.observe(obs, F.count(F.lit(1)).alias("documents"),
                      F.sum(F.size("sentence_lens")).alias("sequences"),
                      F.sum(F.size("token_ids")).alias("tokens"))
    part_id = F.col("key_idx").cast("long") * PART_SPACE + F.col("part")
    out = enc.select(
        part_id.alias("part"), "token_ids", "sentence_lens", *(["fkey"] if spec.per_file else []))
    if spec.per_file:
        out = out.withColumnRenamed("fkey", "tag")
    level = "sentence" if spec.split_sentences else "document"
    staging = spec.output_prefix + "__parts"
    write_binidx(out, staging, dtype=dtype)
    release(spark)
    if spec.quarantine_path:
        parse.quarantine(cls).write.mode("overwrite").parquet(spec.quarantine_path)
    result = {"dtype": dtype, "vocab_size": tok.vocab_size, **(obs.get or {})}
    if spec.per_file:
        result["files"] = _per_file_outputs(spark, spec, staging, level)
        return result
    for k_idx, key in enumerate(spec.json_keys):
        parts = sorted(p[:-4] for p in glob.glob(os.path.join(staging, "part-*.idx"))
                       if int(os.path.basename(p)[5:-4]) // PART_SPACE == k_idx)
        target = f"{spec.output_prefix}_{key}_{level}"
        if spec.merge_partitions:
            merge_binidx(spark, parts, target, delete_parts=True)
        elif spec.partitions > 1:
            _join_sub_parts(spark, parts, target, part_room(spark, spec))
        else:
            os.makedirs(target, exist_ok=True)
            for p in parts:
                for ext in (".bin", ".idx"):
                    os.replace(p + ext, os.path.join(target, os.path.basename(p) + ext))
        result[key] = target
    return result


def _gather_parts(spark: SparkSession, parts: DataFrame) -> None:
    """Merges ``parts(prefix, out)`` into their output datasets, all in one plan:
    pieces are cut in tasks, their places are running sums per output."""
    cat = catalogue_of(spark, parts.select("prefix"))
    pieces = cut_pieces(cat, 1 << 22).join(parts, "prefix")
    before = Window.partitionBy("out").orderBy("prefix", "lo").rowsBetween(Window.unboundedPreceding, -1)
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    plan = pieces.select("out", "prefix", "dtype", "lo", "hi", base("n_seq").alias("seq_base"), base("n_bytes").alias("byte_base"),
                         base("n_docs").alias("doc_base"), "n_seq", "n_bytes", "n_docs")
    gather_table(spark, checkpoint(plan), documents="keep", delete_data=True)
    remove_parts(cat)


def _join_sub_parts(spark: SparkSession, parts: list[str], target: str, room: int) -> None:
    """What several tasks wrote for a reference partition (``room`` ids each) becomes its dataset."""
    rows = [(p, os.path.join(target, f"part-{int(os.path.basename(p)[5:]) % PART_SPACE // room:015d}")) for p in parts]
    outputs = {out for _, out in rows}
    if os.path.isdir(target):  # parts of an earlier build that this one does not write
        for old in glob.glob(os.path.join(target, "part-*.*")):
            if old[:-4] not in outputs:
                os.remove(old)
    if rows:
        _gather_parts(spark, spark.createDataFrame(rows, "prefix string, out string"))


def _per_file_outputs(spark: SparkSession, spec: CorpusSpec, staging: str, level: str) -> dict:
    """Merge the parts (input splits) of every file into
    ``{prefix}_{relative path}_{key}_{level}``, all files in one plan. The writer
    recorded each part's file in ``parts.jsonl`` (one line per part), so no
    extra scan."""
    keys = F.array(*[F.lit(k) for k in spec.json_keys])
    key = F.element_at(keys, F.expr(f"CAST(substring(part, 6) AS BIGINT) div {PART_SPACE}").cast("int") + 1)
    parts = (spark.read.schema("part string, tag string").json(os.path.join(staging, "parts.jsonl"))
             .select(F.concat(F.lit(staging + "/"), "part").alias("prefix"), F.col("tag").alias("file"), key.alias("key")))
    parts = checkpoint(parts.withColumn("out", F.concat(F.lit(spec.output_prefix + "_"), "file", F.lit("_"), "key", F.lit("_" + level))))
    _gather_parts(spark, parts.select("prefix", "out"))
    files = parts.select("file", "key", "out").distinct().orderBy("key", "file").collect()  # one row per output dataset
    return {r["file"] if len(spec.json_keys) == 1 else f"{r['file']}:{r['key']}": r["out"] for r in files}


def write_split_sentences(spark: SparkSession, spec: CorpusSpec, out: str) -> None:
    """SN3: the sentence-split corpus as JSONL ``{"key": [sentences], ...}``
    (only the requested keys; UTF-8, not ASCII-escaped), in line order
    (one range shuffle on ``line_id``; files are numbered in that order)."""
    keys = list(spec.json_keys)
    cls = parse.classify(read_lines(spark, spec.input), keys)
    ok = cls.where(F.col("reason").isNull())
    js = F.to_json(F.struct(*[text.split_values(F.col(k), spec.keep_newlines,
                                                abbreviations=spec.abbreviations or None).alias(k)
                              for k in keys]))
    (ok.select("line_id", js.alias("value")).repartitionByRange("line_id")
     .sortWithinPartitions("line_id").select("value").write.mode("overwrite").text(out))
