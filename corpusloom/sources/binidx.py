"""Indexed token datasets (``.bin`` + ``.idx``) as a Spark data source.

Source (S3/S4/S10) and sink (SN1) for the memory-mapped binary format, as a
Python Data Source named ``binidx``. Layout of ``.idx`` (little-endian):

    magic b"MMIDIDX\\x00\\x00" | u64 version=1 | u8 dtype code
    | u64 S (sequences) | u64 D (document index length = documents + 1)
    | int32[S] lengths | int64[S] byte pointers | int64[D] document index
    | int8[S] modes (only in multimodal datasets; not flagged in the header)

``.bin`` is the raw concatenation of all tokens.

Reading: the driver reads only the 34-byte headers and file sizes, and plans
one input partition per range of sequences (about ``bytesPerPartition`` of
``.bin`` each); tasks read their slice of the index and of the data and yield
Arrow batches. Options: ``path`` (folder of ``*.idx``, a prefix, or several
separated by commas), ``table`` = ``sequences`` (default) | ``documents``,
``columns`` = ``all`` (default) | ``index`` (no ``.bin`` access),
``multimodal`` (read the mode bytes), ``dtype`` (element type of ``tokens``
when the folder is empty).

Writing: one dataset per value of the ``part`` column, named
``part-{part:015d}`` (an optional string column ``tag`` is recorded per part
in ``parts.jsonl``); rows must be ordered by (part, document) inside each
Spark partition and a part must not span partitions (partition by range or by
input split). Each row is one document: ``token_ids`` and ``sentence_lens``
(and optional ``modes``). Files are written under attempt-specific names and
renamed by the driver's commit, so task retries and speculation leave no
partial dataset behind. Options: ``path``, ``dtype``, ``multimodal``.
"""

from __future__ import annotations

import glob
import os
import shutil
import struct
import uuid
from bisect import bisect_left, bisect_right
from dataclasses import dataclass, field
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

from corpusloom.operators.index import CODE_DTYPES, DTYPE_CODES, DTYPE_SIZES
from corpusloom.session import local_path

# Fixed values of the file format.
MAGIC = b"MMIDIDX\x00\x00"
VERSION = 1
HEADER_SIZE = 34

_SPARK_ELEM = {"uint8": "smallint", "int8": "tinyint", "int16": "smallint", "uint16": "int",
               "int32": "int", "int64": "bigint", "float32": "float", "float64": "double"}
_ARROW_ELEM = {"uint8": pa.int16(), "int8": pa.int8(), "int16": pa.int16(), "uint16": pa.int32(),
               "int32": pa.int32(), "int64": pa.int64(), "float32": pa.float32(), "float64": pa.float64()}


# Bytes of tokens in one Arrow batch of the reader, at most (unless one sequence is longer).
BATCH_BYTES = 8 << 20


@dataclass
class Header:
    prefix: str
    dtype: str
    n_seq: int
    n_doc_idx: int
    bin_size: int

    @property
    def itemsize(self) -> int:
        return DTYPE_SIZES[self.dtype]


def read_header(prefix: str) -> Header:
    idx = prefix + ".idx"
    with open(idx, "rb") as f:
        head = f.read(HEADER_SIZE)
    if len(head) < HEADER_SIZE or head[:9] != MAGIC:
        raise ValueError(f"bad header, cannot read: {idx}")
    (version,) = struct.unpack("<Q", head[9:17])
    if version != VERSION:
        raise ValueError(f"bad version, cannot read: {idx}")
    code = head[17]
    if code not in CODE_DTYPES:
        raise ValueError(f"unknown dtype code {code}: {idx}")
    n_seq, n_doc = struct.unpack("<QQ", head[18:34])
    bin_path = prefix + ".bin"
    bin_size = os.path.getsize(bin_path) if os.path.exists(bin_path) else -1
    return Header(prefix, CODE_DTYPES[code], n_seq, n_doc, bin_size)


def list_prefixes(path: str) -> list[str]:
    """Expand the ``path`` option into sorted dataset prefixes."""
    out: list[str] = []
    for p in [s.strip() for s in path.split(",") if s.strip()]:
        p = local_path(p)
        if os.path.isdir(p):
            out.extend(sorted(f[:-4] for f in glob.glob(os.path.join(p, "*.idx"))))
        elif p.endswith(".idx") or p.endswith(".bin"):
            out.append(p[:-4])
        else:
            out.append(p)
    return out


def _index_arrays(prefix: str, h: Header, multimodal: bool):
    """Memory maps of the index arrays (lengths, pointers, doc index, modes)."""
    mm = np.memmap(prefix + ".idx", mode="r", dtype=np.uint8)
    off = HEADER_SIZE
    lengths = mm[off:off + 4 * h.n_seq].view("<i4")
    off += 4 * h.n_seq
    pointers = mm[off:off + 8 * h.n_seq].view("<i8")
    off += 8 * h.n_seq
    doc_idx = mm[off:off + 8 * h.n_doc_idx].view("<i8")
    off += 8 * h.n_doc_idx
    modes = mm[off:off + h.n_seq].view("i1") if multimodal else None
    return lengths, pointers, doc_idx, modes


def _schema(table: str, columns: str, dtype: str, tagged: bool = False) -> str:
    if table == "documents":
        return "prefix string, doc_id bigint, seq_begin bigint, seq_end bigint"
    cols = ("prefix string, seq_id bigint, file_seq bigint, doc_id bigint, sent_pos int, length int, "
            "ptr bigint, mode tinyint")
    if tagged:
        cols += ", tag bigint"
    if columns != "index":
        cols += f", tokens array<{_SPARK_ELEM[dtype]}>"
    return cols


@dataclass
class _Range(InputPartition):
    prefix: str
    dtype: str
    lo: int
    hi: int
    seq_base: int
    doc_base: int
    n_seq: int
    n_doc_idx: int
    bin_size: int
    tag: int = -1


class BinIdxReader(DataSourceReader):
    def __init__(self, options, schema: StructType):
        self.options = options
        self.schema = schema
        self.table = options.get("table", "sequences")
        self.columns = options.get("columns", "all")
        self.multimodal = options.get("multimodal", "false").lower() == "true"
        self.target = int(options.get("bytesPerPartition", str(128 << 20)))
        self.max_rows = int(options.get("rowsPerPartition", str(1 << 22)))
        self.seq_lo, self.seq_hi = 0, None  # pushed-down seq_id bounds [lo, hi)

    def pushFilters(self, filters):
        """J4 pushdown: comparisons of ``seq_id`` with a constant prune the
        input partitions and trim their ranges; other filters stay in Spark."""
        from pyspark.sql.datasource import (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan,
                                            LessThanOrEqual)
        for f in filters:
            col = getattr(f, "attribute", None)
            if self.table != "sequences" or col != ("seq_id",) or not isinstance(getattr(f, "value", None), int):
                yield f
                continue
            v = f.value
            if isinstance(f, GreaterThan):
                self.seq_lo = max(self.seq_lo, v + 1)
            elif isinstance(f, GreaterThanOrEqual):
                self.seq_lo = max(self.seq_lo, v)
            elif isinstance(f, LessThan):
                self.seq_hi = v if self.seq_hi is None else min(self.seq_hi, v)
            elif isinstance(f, LessThanOrEqual):
                self.seq_hi = v + 1 if self.seq_hi is None else min(self.seq_hi, v + 1)
            elif isinstance(f, EqualTo):
                self.seq_lo = max(self.seq_lo, v)
                self.seq_hi = v + 1 if self.seq_hi is None else min(self.seq_hi, v + 1)
            else:
                yield f

    def _prune(self, parts):
        if self.table != "sequences" or (self.seq_lo == 0 and self.seq_hi is None):
            return parts
        out = []
        hi_b = self.seq_hi if self.seq_hi is not None else float("inf")
        for p in parts:
            lo = max(p.lo, self.seq_lo - p.seq_base)
            hi = min(p.hi, hi_b - p.seq_base)
            if hi > lo:
                out.append(_Range(p.prefix, p.dtype, int(lo), int(hi), p.seq_base, p.doc_base,
                                  p.n_seq, p.n_doc_idx, p.bin_size, p.tag))
        return out or [_Range("", "int32", 0, 0, 0, 0, 0, 0, 0)]

    def partitions(self):
        if self.options.get("ranges"):
            return self._prune(self._range_partitions(self.options["ranges"]))
        return self._prune(self._file_partitions())

    def _file_partitions(self):
        parts = []
        seq_base = doc_base = 0
        dtype0 = None
        for prefix in list_prefixes(self.options["path"]):
            h = read_header(prefix)
            if dtype0 is None:
                dtype0 = h.dtype
            elif h.dtype != dtype0:
                raise ValueError(f"mixed dtypes {dtype0} and {h.dtype} in one read")
            n_items = h.n_doc_idx - 1 if self.table == "documents" else h.n_seq
            size = max(h.bin_size, 0) if self.table != "documents" and self.columns != "index" else 12 * n_items
            n_split = max(1, -(-size // self.target), -(-n_items // self.max_rows))
            for lo, hi in self._cuts(prefix, h, n_items, n_split):
                if hi > lo:
                    parts.append(_Range(prefix, h.dtype, lo, hi, seq_base, doc_base,
                                        h.n_seq, h.n_doc_idx, h.bin_size))
            seq_base += h.n_seq
            doc_base += max(h.n_doc_idx - 1, 0)
        return parts or [_Range("", "int32", 0, 0, 0, 0, 0, 0, 0)]

    def _cuts(self, prefix: str, h: Header, n_items: int, n: int):
        """Ranges of a file: ``n`` of about equal bytes of ``.bin``, found by
        bisecting the pointers (a few page reads per cut), and none of more than
        ``rowsPerPartition`` items."""
        edges = [n_items * k // n for k in range(n + 1)]
        if n > 1 and self.table != "documents" and self.columns != "index":
            pointers = _index_arrays(prefix, h, False)[1]
            by_bytes = [bisect_left(pointers, h.bin_size * k // n) for k in range(1, n)]
            edges = sorted({0, n_items, *by_bytes})
        for lo, hi in zip(edges, edges[1:]):
            for a in range(lo, hi, self.max_rows):
                yield a, min(hi, a + self.max_rows)

    def _range_partitions(self, ranges_path: str):
        """Explicit ``(prefix, lo, hi, tag)`` ranges (JSON lines), e.g. the
        chunks of a reshard plan: each becomes one input partition."""
        import json
        rows = [json.loads(ln) for ln in open(local_path(ranges_path), encoding="utf-8") if ln.strip()]
        heads, bases = {}, {}
        seq_base = doc_base = 0
        for pfx in sorted({r["prefix"] for r in rows}):
            h = heads[pfx] = read_header(pfx)
            bases[pfx] = (seq_base, doc_base)
            seq_base += h.n_seq
            doc_base += max(h.n_doc_idx - 1, 0)
        out = []
        for r in rows:
            h = heads[r["prefix"]]
            sb, db = bases[r["prefix"]]
            out.append(_Range(r["prefix"], h.dtype, int(r["lo"]), int(r["hi"]), sb, db,
                              h.n_seq, h.n_doc_idx, h.bin_size, int(r.get("tag", -1))))
        return out or [_Range("", "int32", 0, 0, 0, 0, 0, 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if part.hi <= part.lo:
            return iter(())
        h = Header(part.prefix, part.dtype, part.n_seq, part.n_doc_idx, part.bin_size)
        lengths, pointers, doc_idx, modes = _index_arrays(part.prefix, h, self.multimodal)
        if doc_idx[-1] != h.n_seq:
            raise ValueError(f"document index does not end at the sequence count: {part.prefix}")
        if self.table == "documents":
            d = np.arange(part.lo, part.hi, dtype=np.int64)
            begin = np.asarray(doc_idx[part.lo:part.hi], dtype=np.int64) + part.seq_base
            end = np.asarray(doc_idx[part.lo + 1:part.hi + 1], dtype=np.int64) + part.seq_base
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.prefix] * len(d), pa.string()), pa.array(d + part.doc_base),
                 pa.array(begin), pa.array(end)],
                names=["prefix", "doc_id", "seq_begin", "seq_end"])
            return
        chunk = 1 << 16
        for lo in range(part.lo, part.hi, chunk):
            end = min(part.hi, lo + chunk)
            while lo < end:  # a batch holds at most BATCH_BYTES of tokens, or one sequence
                hi = end if self.columns == "index" else max(
                    lo + 1, bisect_right(pointers, int(pointers[lo]) + BATCH_BYTES, lo, end) - 1)
                if end - hi <= 1 and int(pointers[end - 1]) + int(lengths[end - 1]) * h.itemsize - int(pointers[lo]) <= BATCH_BYTES:
                    hi = end
                yield self._batch(part, h, lengths, pointers, doc_idx, modes, lo, hi)
                lo = hi

    def _batch(self, part, h, lengths, pointers, doc_idx, modes, lo, hi):
        seq = np.arange(lo, hi, dtype=np.int64)
        lens = np.asarray(lengths[lo:hi], dtype=np.int32)
        ptrs = np.asarray(pointers[lo:hi], dtype=np.int64)
        # document of each sequence: last boundary <= seq (binary search on the map)
        # (only the boundaries around this window are read)
        d0, d1 = bisect_right(doc_idx, lo) - 1, bisect_right(doc_idx, hi - 1)
        bounds = np.array(doc_idx[d0:d1], dtype=np.int64)
        at = np.searchsorted(bounds, seq, side="right") - 1
        docs, first = at + d0, bounds[at]
        n = hi - lo
        arrays = [pa.array([part.prefix] * n, pa.string()), pa.array(seq + part.seq_base), pa.array(seq),
                  pa.array(docs.astype(np.int64) + part.doc_base), pa.array((seq - first).astype(np.int32)),
                  pa.array(lens), pa.array(ptrs),
                  pa.array(np.asarray(modes[lo:hi], dtype=np.int8)) if modes is not None
                  else pa.nulls(n, pa.int8())]
        names = ["prefix", "seq_id", "file_seq", "doc_id", "sent_pos", "length", "ptr", "mode"]
        if self.options.get("ranges"):
            arrays.append(pa.array(np.full(n, part.tag, dtype=np.int64)))
            names.append("tag")
        if self.columns != "index":
            item = h.itemsize
            start = int(ptrs[0]) if n else 0
            end = int(ptrs[-1]) + int(lens[-1]) * item if n else 0
            with open(part.prefix + ".bin", "rb") as f:
                f.seek(start)
                raw = f.read(end - start)
            np_dtype = np.dtype(h.dtype).newbyteorder("<")
            vals = np.frombuffer(raw, dtype=np_dtype)
            if np.dtype(h.dtype) == np.uint16:
                vals = vals.astype(np.int32)
            elif np.dtype(h.dtype) == np.uint8:
                vals = vals.astype(np.int16)
            offs = np.concatenate((((ptrs - start) // item), [(end - start) // item])).astype(np.int32)
            if not np.all(np.diff(offs) == lens):
                # pointers need not be contiguous in a foreign file: gather
                pieces = [vals[(p - start) // item:(p - start) // item + ln] for p, ln in zip(ptrs, lens)]
                vals = np.concatenate(pieces) if pieces else vals[:0]
                offs = np.concatenate(([0], np.cumsum(lens))).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offs), pa.array(vals, _ARROW_ELEM[h.dtype])))
            names.append("tokens")
        return pa.RecordBatch.from_arrays(arrays, names=names)


@dataclass
class _Written(WriterCommitMessage):
    files: list = field(default_factory=list)  # (tmp_prefix, final_prefix)
    tags: list = field(default_factory=list)   # (part file name, tag) when a tag column is given


class BinIdxWriter(DataSourceArrowWriter):
    def __init__(self, options, schema: StructType, overwrite: bool):
        self.path = local_path(options["path"])
        self.dtype = options.get("dtype", "uint16")
        if self.dtype not in DTYPE_CODES:
            raise ValueError(f"unknown dtype {self.dtype}")
        self.multimodal = options.get("multimodal", "false").lower() == "true"
        self.overwrite = overwrite
        self.has_modes = "modes" in schema.fieldNames()
        self.name_format = options.get("nameFormat", "part-{part:015d}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext
        ctx = TaskContext.get()
        tag = f"{ctx.partitionId()}-{ctx.attemptNumber()}-{uuid.uuid4().hex[:8]}" if ctx else uuid.uuid4().hex
        tmp_dir = os.path.join(self.path, "_temporary")
        os.makedirs(tmp_dir, exist_ok=True)
        msg = _Written()
        cur = None  # [part, bin file, lengths list, doc counts list, modes list, tmp, tag]
        tags = {}
        np_dtype = np.dtype(self.dtype).newbyteorder("<")
        info = np.iinfo(np_dtype) if np_dtype.kind in "iu" else None

        def close(c):
            part, fh, lens, ndocs, modes, tmp, ptag = c
            fh.close()
            _write_idx(tmp + ".idx", self.dtype, np.concatenate(lens) if lens else np.zeros(0, np.int32),
                       np.concatenate(ndocs) if ndocs else np.zeros(0, np.int64),
                       (np.concatenate(modes) if modes else np.zeros(0, np.int8)) if self.multimodal else None)
            final = os.path.join(self.path, self.name_format.format(part=part))
            msg.files.append((tmp, final))
            if ptag is not None:
                msg.tags.append((os.path.basename(final), ptag))

        for b in iterator:
            parts = np.asarray(b.column("part"), dtype=np.int64)
            if len(parts) == 0:
                continue
            cuts = np.flatnonzero(np.diff(parts)) + 1
            for s, e in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(parts)]))):
                p = int(parts[s])
                if cur is None or cur[0] != p:
                    if cur is not None:
                        close(cur)
                    tmp = os.path.join(tmp_dir, f"part-{p:015d}-{tag}")
                    ptag = (b.column("tag")[int(s)].as_py() if "tag" in b.schema.names else None)
                    cur = [p, open(tmp + ".bin", "wb"), [], [], [], tmp, ptag]
                sub = b.slice(s, e - s)
                toks = sub.column("token_ids")
                lens = sub.column("sentence_lens")
                vals = np.asarray(toks.flatten())
                if info is not None and len(vals) and (vals.min() < info.min or vals.max() > info.max):
                    raise ValueError(f"token id out of range for {self.dtype}: "
                                     f"[{vals.min()}, {vals.max()}]")
                lv = np.asarray(lens.flatten(), dtype=np.int32)
                lo = np.asarray(lens.offsets)
                if lv.sum() != len(vals):
                    raise ValueError("sentence_lens do not add up to the token count")
                cur[1].write(vals.astype(np_dtype).tobytes())
                cur[2].append(lv)
                cur[3].append(np.diff(lo).astype(np.int64))
                if self.multimodal:
                    if self.has_modes:
                        mcol = sub.column("modes")
                        per_doc = np.diff(lo)
                        if mcol.null_count:  # a document without modes gets zeros (Q23)
                            ms = [np.zeros(per_doc[i], np.int8) if m is None else np.asarray(m, np.int8)
                                  for i, m in enumerate(mcol.to_pylist())]
                            mv = np.concatenate(ms) if ms else np.zeros(0, np.int8)
                        else:
                            mv = np.asarray(mcol.flatten(), dtype=np.int8)
                        if len(mv) != len(lv):
                            raise ValueError("modes must have one entry per sequence")
                        cur[4].append(mv)
                    else:
                        cur[4].append(np.zeros(len(lv), np.int8))
        if cur is not None:
            close(cur)
        return msg

    def commit(self, messages) -> None:
        finals = set()
        for m in messages:
            for _, final in m.files:
                if final in finals:
                    self.abort(messages)
                    raise ValueError(f"part {final} was written by two tasks: a part must not span partitions")
                finals.add(final)
        if self.overwrite and self.name_format.startswith("part-"):
            for f in glob.glob(os.path.join(self.path, "part-*.idx")):
                if f[:-4] not in finals:
                    for ext in (".idx", ".bin"):
                        if os.path.exists(f[:-4] + ext):
                            os.remove(f[:-4] + ext)
        for m in messages:
            for tmp, final in m.files:
                os.makedirs(os.path.dirname(final), exist_ok=True)
                os.replace(tmp + ".bin", final + ".bin")
                os.replace(tmp + ".idx", final + ".idx")
        tags = [t for m in messages for t in m.tags]
        if tags:  # which part holds what (e.g. the input file of a split); an overwrite starts anew
            import json
            with open(os.path.join(self.path, "parts.jsonl"), "w" if self.overwrite else "a", encoding="utf-8") as f:
                for name, t in sorted(tags):
                    f.write(json.dumps({"part": name, "tag": t}) + "\n")
        shutil.rmtree(os.path.join(self.path, "_temporary"), ignore_errors=True)

    def abort(self, messages) -> None:
        shutil.rmtree(os.path.join(self.path, "_temporary"), ignore_errors=True)


def _write_idx(path: str, dtype: str, lengths: np.ndarray, docs_per_row: np.ndarray,
               modes: np.ndarray | None) -> None:
    item = DTYPE_SIZES[dtype]
    lengths = lengths.astype("<i4")
    ptr = np.zeros(len(lengths), dtype="<i8")
    if len(lengths) > 1:
        np.cumsum(lengths[:-1].astype(np.int64) * item, out=ptr[1:])
    doc_idx = np.concatenate(([0], np.cumsum(docs_per_row))).astype("<i8")
    with open(path, "wb") as f:
        f.write(MAGIC)
        f.write(struct.pack("<Q", VERSION))
        f.write(struct.pack("<B", DTYPE_CODES[dtype]))
        f.write(struct.pack("<Q", len(lengths)))
        f.write(struct.pack("<Q", len(doc_idx)))
        f.write(lengths.tobytes())
        f.write(ptr.tobytes())
        f.write(doc_idx.tobytes())
        if modes is not None:
            f.write(modes.astype("i1").tobytes())


class BinIdxDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binidx"

    def schema(self) -> str:
        table = self.options.get("table", "sequences")
        columns = self.options.get("columns", "all")
        dtype = self.options.get("dtype")
        if dtype is None and not self.options.get("ranges"):
            prefixes = list_prefixes(self.options.get("path", "")) if self.options.get("path") else []
            dtype = read_header(prefixes[0]).dtype if prefixes else "int32"
        ranges = self.options.get("ranges")
        if dtype is None and ranges:
            import json
            with open(local_path(ranges), encoding="utf-8") as f:
                first = next((json.loads(ln) for ln in f if ln.strip()), None)
            dtype = read_header(first["prefix"]).dtype if first else "int32"
        return _schema(table, columns, dtype, tagged=bool(ranges))

    def reader(self, schema: StructType) -> BinIdxReader:
        return BinIdxReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> BinIdxWriter:
        return BinIdxWriter(self.options, schema, overwrite)


def register(spark) -> None:
    from corpusloom.session import prepare_session
    prepare_session(spark)
    spark.dataSource.register(BinIdxDataSource)


def write_binidx(df, path: str, dtype: str = "uint16", multimodal: bool = False,
                 mode: str = "overwrite", name_format: str | None = None) -> None:
    """SN1: write ``df(part, token_ids, sentence_lens[, modes])`` (one row per
    document, sorted by part then document inside each partition)."""
    register(df.sparkSession)
    (df.write.format("binidx").mode(mode).option("path", path).option("dtype", dtype)
     .option("multimodal", str(multimodal).lower())
     .option("nameFormat", name_format or "part-{part:015d}").save())


def read_binidx(spark, path: str, table: str = "sequences", columns: str = "all",
                multimodal: bool = False, **options):
    """Read one or more indexed datasets."""
    register(spark)
    r = (spark.read.format("binidx").option("path", path).option("table", table)
         .option("columns", columns).option("multimodal", str(multimodal).lower()))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()
