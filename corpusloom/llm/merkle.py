"""Merkle manifest of a dataset over retained SHA-256 midstates.

Each row is a leaf; per language the leaves ascend by ``doc_id`` and every run
of eight nodes becomes one parent until one node, the subroot, is left; the
subroots, ordered by language, give the root in the same way.

A child digest is hashed as 64 hex digits, which is exactly one SHA-256 block.
The hash state before each child slot is therefore eight 32-bit words with no
partial block, and a parent keeps a copy of it for every slot (``raise_run``).
Folding a replaced child (``fold``) starts from the copy before its slot and
compresses the replacement and the siblings to its right only; nothing to its
left is hashed again. States are numpy arrays over many rows at once, so they
travel between Spark tasks as plain binary columns.

How it is spread: leaves are ranked by a range sort and prefix sums over its
partitions; ``SPAN`` = 8^4 consecutive leaves form one group, which builds four
levels and folds its own leaves. The group's nodes (1 / 4096 of the rows) are
grouped again, until one is left, so a language with most rows is many groups.
What the upper levels add to a fold (``path``) is joined back once, by group.

Defined cases: a null ``doc_id`` sorts first; rows with equal ``doc_id`` are
leaves of their own, by leaf digest (equal rows are interchangeable); null
``lang`` is a language of its own, before the empty string; a null field is
``-``; long texts are hashed whole in the JVM; an empty table gives no rows;
missing columns count as null, other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import prepare, stored

ARITY = 8
LEVELS = 4                 # levels that one group of nodes builds
SPAN = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PLACE = 2 + 32 + ARITY * 32   # bytes of one level in a path: slot, size, midstate, the run's digests
BATCH_ROWS = 8192
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- SHA-256 over arrays

def _primes(n: int) -> list[int]:
    out = []
    k = 2
    while len(out) < n:
        if all(k % p for p in out):
            out.append(k)
        k += 1
    return out


def _cube_root(x: int) -> int:
    lo, hi = 0, 1 << (x.bit_length() // 3 + 2)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if mid ** 3 <= x else (lo, mid)
    return lo


# The standard's constants: fractional parts of roots of the first primes.
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], dtype=np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)
_DIGITS = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), dtype=">u2").astype(np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """``state`` (8, n) after one block (16, n) for each of n messages."""
    w = list(block)
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(w[i - 16] + (_turn(a, 7) ^ _turn(a, 18) ^ (a >> np.uint32(3))) + w[i - 7]
                 + (_turn(b, 17) ^ _turn(b, 19) ^ (b >> np.uint32(10))))
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        x = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + _ROUND[i] + w[i]
        y = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) ^ (a & c) ^ (b & c))
        a, b, c, d, e, f, g, h = x + y, a, b, c, d + x, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digests (8, n) as blocks (16, n) of their 64 hex digits."""
    out = np.empty((16, digest.shape[1]), dtype=np.uint32)
    for half in (0, 1):
        s = np.uint32(16 * (1 - half))
        out[half::2] = (_DIGITS[(digest >> (s + np.uint32(8))) & np.uint32(255)] << np.uint32(16)) | _DIGITS[(digest >> s) & np.uint32(255)]
    return out


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digest of messages of so many whole blocks: the padding is a block of its own."""
    pad = np.zeros((16, state.shape[1]), dtype=np.uint32)
    pad[0] = 0x80000000
    bits = blocks.astype(np.uint64) * np.uint64(512)
    pad[14], pad[15] = (bits >> np.uint64(32)).astype(np.uint32), bits.astype(np.uint32)
    return compress(state, pad)


def start(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, axis=1)


def _go_on(state: np.ndarray, digest: np.ndarray, where: np.ndarray) -> None:
    at = np.nonzero(where)[0]
    if len(at):
        state[:, at] = compress(state[:, at], hex_block(digest[:, at]))


# ---------------------------------------------------------------- the tree

def levels_of(n: int) -> int:
    """Levels that ``n`` nodes need until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // ARITY), k + 1
    return k


def raise_run(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One level over ``nodes`` (8, n): the parents' digests, the midstates
    (slots, 8, parents) kept before each child slot, the children in the same
    layout, and the runs' sizes."""
    n = nodes.shape[1]
    g = -(-n // ARITY)
    size = np.full(g, ARITY)
    size[-1] = n - ARITY * (g - 1)
    kids = np.zeros((8, g * ARITY), dtype=np.uint32)
    kids[:, :n] = nodes
    kids = kids.reshape(8, g, ARITY).transpose(2, 0, 1)
    state, kept = start(g), np.zeros((ARITY, 8, g), dtype=np.uint32)
    for slot in range(ARITY):
        kept[slot] = state
        _go_on(state, kids[slot], slot < size)
    return finish(state, size), kept, kids, size


def fold(now: np.ndarray, slot: np.ndarray, size: np.ndarray, midstate: np.ndarray, kids: np.ndarray) -> np.ndarray:
    """Parents' digests when the child at ``slot`` is ``now``: resumes the state
    kept before the slot with the replacement, then the siblings to its right."""
    state = compress(midstate, hex_block(now))
    for other in range(1, ARITY):
        _go_on(state, kids[other], (other > slot) & (other < size))
    return finish(state, size)


def note_siblings(proof: np.ndarray, count: np.ndarray, slot: np.ndarray, size: np.ndarray, kids: np.ndarray) -> None:
    """Adds a run's other digests, left to right, to the proofs' running hashes."""
    for other in range(ARITY):
        there = (other != slot) & (other < size)
        _go_on(proof, kids[other], there)
        count += there


def build(nodes: np.ndarray, levels: int) -> tuple[np.ndarray, list[tuple]]:
    """``levels`` levels over the nodes of one group; per level what a child
    needs: (slot, size, midstate, the run's children) for every bottom node."""
    at, out = np.arange(nodes.shape[1]), []
    for _ in range(levels):
        nodes, kept, kids, size = raise_run(nodes)
        run, slot = at // ARITY, at % ARITY
        out.append((slot, size[run], kept[slot, :, run].T, kids[:, :, run]))
        at = run
    return nodes, out


# ---------------------------------------------------------------- binary columns

def to_words(column: pa.Array, width: int = 8) -> np.ndarray:
    """A binary column of equally long values as (width, n) words."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=">u4").reshape(len(column), width).T.astype(np.uint32)


def to_binary(words: np.ndarray) -> pa.Array:
    raw, n = np.ascontiguousarray(words.T).astype(">u4").tobytes(), words.shape[0] * 4
    return pa.array([raw[i:i + n] for i in range(0, len(raw), n)], pa.binary())


def pack_path(levels: list[tuple], n: int) -> list[bytes]:
    """For each of ``n`` nodes its places on ``levels``, bottom first."""
    if not levels:
        return [b""] * n
    parts = []
    for slot, size, mid, kids in levels:
        parts += [slot[:, None].astype(np.uint8), size[:, None].astype(np.uint8),
                  np.ascontiguousarray(mid.T).astype(">u4").view(np.uint8).reshape(n, 32),
                  np.ascontiguousarray(kids.transpose(2, 0, 1)).astype(">u4").view(np.uint8).reshape(n, ARITY * 32)]
    return [row.tobytes() for row in np.concatenate(parts, axis=1)]


def unpack_place(raw: np.ndarray) -> tuple:
    """The inverse of ``pack_path`` for one level of n rows (n, PLACE)."""
    n = len(raw)
    words = np.ascontiguousarray(raw[:, 2:]).view(">u4").reshape(n, 1 + ARITY, 8).astype(np.uint32)
    return raw[:, 0].astype(np.int64), raw[:, 1].astype(np.int64), words[:, 0].T, words[:, 1:].transpose(1, 2, 0)


# ---------------------------------------------------------------- Spark

def leaf_digest(names: tuple[str, ...], columns: list[str], text: Column | None = None) -> Column:
    """Hex SHA-256 of a row's fields: byte count, colon, value; ``-`` for null."""
    def one(name: str) -> Column:
        if name not in columns:
            return F.lit("-")
        value = text if text is not None and name == "text" else F.col(name)
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[one(n) for n in names]).cast("binary"), 256)


def ranked(df: DataFrame, key: str, *order: str) -> DataFrame:
    """``df`` stored with ``at`` (0-based rank of a row among the rows of its
    ``key`` by ``order``) and ``total`` (rows of the key): a range sort, then
    prefix sums over (partition, key) counts. The row number added to the sort
    key lets equal rows be split over partitions."""
    cols = df.columns
    sort = [key, *order, "_uid"]
    rows = stored(df.withColumn("_uid", F.monotonically_increasing_id())
                  .repartitionByRange(*sort).sortWithinPartitions(*sort)
                  .select(*cols, F.monotonically_increasing_id().alias("_m"))
                  .withColumn("_part", F.shiftright("_m", 33)))
    per = rows.groupBy("_part", key).agg(F.min("_m").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    all_rows = Window.partitionBy(key)
    before = all_rows.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_part", key, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_lo")).alias("_shift"),
                     F.sum("_n").over(all_rows).alias("total"))
    return rows.join(per, ["_part", key]).select(*cols, (F.col("_m") + F.col("_shift")).alias("at"), "total")


def _groups(df: DataFrame, key: str):
    return df.withColumn("up", F.floor(F.col("at") / SPAN).cast("long")).groupBy(key, "up")


def raise_nodes(nodes: DataFrame) -> DataFrame:
    """From nodes (key, at, total, digest): the node of each group of ``SPAN``
    (key, up, total, digest, null path) and each node's path to it (key, at, up, path)."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        n, total = table.num_rows, table["total"][0].as_py()
        levels = min(LEVELS, levels_of(total))
        top, places = build(to_words(table["digest"].combine_chunks()), levels)
        key, up = table["key"][0].as_py(), table["up"][0].as_py()
        return pa.table({
            "key": pa.array([key] * (n + 1), pa.string()),
            "at": pa.concat_arrays([table["at"].combine_chunks(), pa.array([None], pa.int64())]),
            "up": pa.array([up] * (n + 1), pa.int64()),
            "total": pa.array([-(-total // SPAN)] * (n + 1), pa.int64()),
            "digest": pa.concat_arrays([pa.nulls(n, pa.binary()), to_binary(top)]),
            "path": pa.array([*pack_path(places, n), None], pa.binary())})
    return stored(_groups(nodes, "key").applyInArrow(run, "key string, at long, up long, total long, digest binary, path binary"))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From nodes (key, at, total, digest): one node per key (key, digest), and
    each given node's whole path to it (key, at, path)."""
    stages = []
    while True:
        more = nodes.agg(F.max("total")).first()[0]
        if more is None or (stages and more <= 1):
            break
        out = raise_nodes(nodes)
        stages.append(out.where("path IS NOT NULL").select("key", "at", "up", "path"))
        nodes = out.where("path IS NULL").select("key", F.col("up").alias("at"), "total", "digest")
    if not stages:
        return nodes.select("key", "digest"), nodes.select("key", "at", F.lit(b"").alias("path"))
    paths = stages[-1].select("key", "at", "path")
    for lower in reversed(stages[:-1]):
        above = paths.select("key", F.col("at").alias("up"), F.col("path").alias("_above"))
        paths = lower.join(above, ["key", "up"]).select("key", "at", F.concat("path", "_above").alias("path"))
    return nodes.select("key", "digest"), paths


def _big(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= BATCH_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def follow(now: np.ndarray, proof: np.ndarray, count: np.ndarray, paths: list[bytes]) -> None:
    """Folds each row along its path, level by level, in place."""
    length = np.array([len(p) for p in paths])
    for n in np.unique(length[length > 0]):
        rows = np.nonzero(length == n)[0]
        raw = np.frombuffer(b"".join(paths[i] for i in rows), dtype=np.uint8).reshape(len(rows), n)
        own, own_proof, own_count = now[:, rows], proof[:, rows], count[rows]
        for lo in range(0, n, PLACE):
            slot, size, mid, kids = unpack_place(raw[:, lo:lo + PLACE])
            note_siblings(own_proof, own_count, slot, size, kids)
            own = fold(own, slot, size, mid, kids)
        now[:, rows], proof[:, rows], count[rows] = own, own_proof, own_count


def manifest(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root`` and ``verified`` for every row. Where ``tampered`` holds, the
    fold starts from the leaf of ``tampered_text`` instead of the row's own."""
    spark = prepare(docs.sparkSession)
    fields = [c for c in FIELDS if c in docs.columns]
    own = leaf_digest(FIELDS, fields)
    changed = own if tampered is None else F.when(tampered, leaf_digest(FIELDS, fields, tampered_text)).otherwise(own)
    lang = F.col("lang") if "lang" in fields else F.lit(None)
    lang = lang.cast("string")
    leaves = stored(docs.select(
        F.coalesce(F.concat(F.lit("="), lang), F.lit("")).alias("key"),  # null first
        (F.col("doc_id") if "doc_id" in fields else F.lit(None).cast("long")).alias("doc_id"),
        F.unhex(own).alias("leaf"), F.unhex(changed).alias("now")))
    rows = ranked(leaves, "key", "doc_id", "leaf")

    def bottom(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        n, total = table.num_rows, table["total"][0].as_py()
        top, places = build(to_words(table["leaf"].combine_chunks()), min(LEVELS, levels_of(total)))
        now, proof, count = to_words(table["now"].combine_chunks()), start(n), np.zeros(n, dtype=np.int64)
        for slot, size, mid, kids in places:
            note_siblings(proof, count, slot, size, kids)
            now = fold(now, slot, size, mid, kids)
        last = pa.nulls(1, pa.binary())
        return pa.table({
            "key": pa.array([table["key"][0].as_py()] * (n + 1), pa.string()),
            "up": pa.array([table["up"][0].as_py()] * (n + 1), pa.int64()),
            "doc_id": pa.concat_arrays([table["doc_id"].combine_chunks(), pa.nulls(1, table["doc_id"].type)]),
            "leaf": pa.concat_arrays([table["leaf"].combine_chunks(), last]),
            "now": pa.concat_arrays([to_binary(now), to_binary(top)]),
            "proof": pa.concat_arrays([to_binary(proof), last]),
            "count": pa.array([*count.tolist(), None], pa.int64()),
            "total": pa.array([-(-total // SPAN)] * (n + 1), pa.int64())})
    id_type = leaves.schema["doc_id"].dataType.simpleString()
    built = stored(_groups(rows, "key").applyInArrow(
        bottom, f"key string, up long, doc_id {id_type}, leaf binary, now binary, proof binary, count long, total long"))
    subroots, inner = climb(built.where("count IS NULL").select("key", F.col("up").alias("at"), "total", F.col("now").alias("digest")))
    subroots = stored(subroots)
    top = ranked(subroots.select(F.lit("").alias("key"), F.col("key").alias("lang"), "digest"), "key", "lang")
    roots, outer = climb(top.select("key", "at", "total", "digest"))
    root = roots.select("digest").first()  # one digest
    root = bytes(root[0]) if root else b""
    langs = (top.join(outer, ["key", "at"])
             .select(F.col("lang").alias("key"), F.col("digest").alias("subroot"), F.col("path").alias("_outer")))
    paths = inner.join(langs, "key").select("key", F.col("at").alias("up"), "subroot", F.concat("path", "_outer").alias("path"))

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _big(batches):
            now, proof = to_words(t["now"].combine_chunks()), to_words(t["proof"].combine_chunks())
            count = t["count"].to_numpy().copy()
            follow(now, proof, count, t["path"].to_pylist())
            yield pa.RecordBatch.from_arrays([
                t["doc_id"].combine_chunks(), t["leaf"].combine_chunks(), t["subroot"].combine_chunks(),
                to_binary(finish(proof, count)), to_binary(now)], names=["doc_id", "leaf", "subroot", "proof", "now"])
    done = (built.where("count IS NOT NULL").join(paths, ["key", "up"])
            .select("doc_id", "leaf", "subroot", "proof", "now", "count", "path")
            .mapInArrow(upper, f"doc_id {id_type}, leaf binary, subroot binary, proof binary, now binary"))
    text = lambda c: F.lower(F.hex(c))
    return done.select("doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), F.lit(root.hex()).alias("root"),
                       text("proof").alias("proof_sha256"), text("now").alias("folded_root"),
                       (F.col("now") == F.lit(root)).alias("verified"))


def every_third(doc_id: Column) -> Column:
    """Rows whose unsigned crc32 of the decimal ``doc_id`` is a multiple of three (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def audited(docs: DataFrame) -> DataFrame:
    """The manifest against a copy in which every third row's text lost its capitals."""
    return manifest(docs, every_third(F.col("doc_id")), F.translate(F.col("text"), *LOWER))
