"""Exact removal of repeated byte strings with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller document, or the same one further left) is removed. The corpus is
never sorted in one place:

1. *Anchors.* Of the ``GRAM``-byte strings in each window of ``LENGTH`` bytes
   those with the smallest hash are anchors, so equal windows hold equal
   anchors at equal offsets, and only anchors whose hash occurs twice matter.
2. *Classes.* Anchors with equal surroundings (the bytes of every window that
   holds the anchor) form a class; all but its first member are covered.
3. *Halving.* What is left is one row per class: anchors of equal hash with
   different surroundings. A window reaches ``SIDE`` bytes beyond the anchor, on
   both sides together, so it takes half of them on the left or half on the
   right: each row is dealt twice, with the nearer left half and with the nearer
   right half, and only rows of one deal can share a window there. A group of
   more than ``GROUP_ROWS`` rows is dealt again in the same way, with what is
   left of its sides, until groups are small or share the whole window.
4. *Suffix arrays.* The sides of a group's rows are written over a small
   alphabet (a symbol stands for the bytes between two depths at which other
   rows of the group part) and sorted by ``gsaca``; a window is an interval of
   the suffix array whose neighbours have its length in common, and all rows of
   an interval but the first are covered.
5. Covered ranges are merged per document and cut out of its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import discard, prepare, stored, text_key
from corpusloom.llm.gsaca import suffix_array

LENGTH = 100
GRAM = 50
WINDOW = LENGTH - GRAM + 1   # grams in a window
SIDE = LENGTH - GRAM         # bytes on either side of an anchor that its windows reach
BLOCK = 1 << 18              # bytes of a text that are hashed at a time
GROUP_ROWS = 1 << 16         # rows of a group that are sorted together, at most (some 30 MB)
SORTED_ROWS = 4096           # rows whose suffix array is built at a time, about
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


@lru_cache(maxsize=2)
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    back = np.uint64(pow(int(base), -1, 1 << 64))
    out = []
    for x in (base, back):
        a = np.full(BLOCK + 8 * LENGTH, x)
        a[0] = 1
        out.append(np.cumprod(a, dtype=np.uint64))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _sums(x: np.ndarray, which: int) -> np.ndarray:
    up, _ = _powers(which)
    out = np.zeros(len(x) + 1, dtype=np.uint64)
    np.cumsum((x + np.uint64(1)) * up[:len(x)], dtype=np.uint64, out=out[1:])
    return out


def _sliding(a: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum or maximum of every window, by doubling."""
    step = 1
    while 2 * step <= width:
        a = pick(a[:-step], a[step:])
        step *= 2
    rest = width - step
    return pick(a[:len(a) - rest], a[rest:]) if rest else a


def anchors(data: bytes, full: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, hash and (``full``) hash of the surroundings of every anchor.
    Long texts are read in overlapping blocks."""
    n, found = len(data), []
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, n - LENGTH + 1, BLOCK):
        # windows that start in [at, at + BLOCK), and what surrounds their anchors
        low, high = max(0, at - SIDE), min(n, at + BLOCK + LENGTH - 1 + SIDE)
        x = raw[low:high].astype(np.uint64)
        _, back = _powers(0)
        sums = _sums(x, 0)
        a, b = at - low, min(n, at + BLOCK + LENGTH - 1) - low
        h = _mix((sums[a + GRAM:b + 1] - sums[a:b - GRAM + 1]) * back[a:b - GRAM + 1])
        rank = (h >> np.uint64(32)).astype(np.uint32)  # half the hash chooses; ties are all anchors
        least = _sliding(rank, WINDOW, np.minimum)
        edge = np.zeros(WINDOW - 1, dtype=np.uint32)
        most = _sliding(np.concatenate([edge, least, edge]), WINDOW, np.maximum)
        pos = np.nonzero(most == rank)[0]
        if not full:
            found.append((pos + at, h[pos], pos))
            continue
        left = np.maximum(pos + a - SIDE, 0)
        right = np.minimum(pos + a + GRAM + SIDE, len(x))
        sums, (_, back) = _sums(x, 1), _powers(1)
        around = _mix((sums[right] - sums[left]) * back[left] + (pos + a - left).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        found.append((pos + at, h[pos], around))
    pos, h, around = (np.concatenate(c) for c in zip(*found))
    pos, keep = np.unique(pos, return_index=True)
    return pos, h[keep].view(np.int64), around[keep].view(np.int64)


def _keyed(docs: DataFrame, column: str) -> DataFrame:
    return docs.select("doc_id", text_key(F.col(column)).alias("tkey"), F.coalesce(F.col(column), F.lit("")).alias("t"))


def _anchor_rows(keyed: DataFrame, full: bool) -> DataFrame:
    """``h`` alone, or with ``around``, the document's key and the position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [anchors(t.encode("utf-8"), full) for t in b.column(2).to_pylist()]
            sizes = np.array([len(g[0]) for g in got], dtype=np.int64)
            if not sizes.sum():
                continue
            h = pa.array(np.concatenate([g[1] for g in got]))
            if not full:
                yield pa.RecordBatch.from_arrays([h], names=["h"])
                continue
            row = pa.array(np.repeat(np.arange(len(got)), sizes))
            yield pa.RecordBatch.from_arrays(
                [h, pa.array(np.concatenate([g[2] for g in got])), b.column(0).take(row), b.column(1).take(row),
                 pa.array(np.concatenate([g[0] for g in got]).astype(np.int32))], names=["h", "around", "doc_id", "tkey", "pos"])
    return keyed.mapInArrow(run, "h long, around long, doc_id long, tkey long, pos int" if full else "h long")


def _order(pos: str | Column = "pos") -> Column:
    """Order of places: by document (null ids last, ties by the text's hash), then position."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("tkey"), (F.col(pos) if isinstance(pos, str) else pos).alias("pos"))


# -- windows of different surroundings

def _shared(rows: list[bytes], group: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, common)``: rows sorted within groups, and for each place in
    that order the length of the common prefix with the row before."""
    keys = [b"%08x" % g + r for g, r in zip(group.tolist(), rows)]
    order = np.array(sorted(range(len(rows)), key=keys.__getitem__), dtype=np.int64)
    size = np.array([len(r) for r in rows], dtype=np.int64)
    wide = np.zeros((len(rows), side + 1), dtype=np.uint8)
    flat = np.frombuffer(b"".join(rows), dtype=np.uint8)
    at = np.repeat(np.arange(len(rows)), size)
    wide[at, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    wide, size, g = wide[order], size[order], group[order]
    common = np.zeros(len(rows), dtype=np.int64)
    same = np.minimum((wide[1:] != wide[:-1]).argmax(axis=1) + side * (wide[1:] == wide[:-1]).all(axis=1), side)
    common[1:] = np.where(g[1:] == g[:-1], np.minimum(same, np.minimum(size[1:], size[:-1])), 0)
    return order, common


def _branches(group: np.ndarray, order: np.ndarray, common: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the longest prefix shared with another row of its group (``reach``);
    ``(depth, symbol)``: for each row and each k, the k-th depth at which some row
    parts from it, and a symbol for the bytes up to there (0 beyond)."""
    n = len(order)
    reach = np.zeros(n, dtype=np.int64)
    reach[order] = np.maximum(common, np.append(common[1:], 0))
    depth = np.zeros((n, side), dtype=np.int64)
    symbol = np.zeros((n, side), dtype=np.int64)
    many = np.zeros(n, dtype=np.int64)
    g = group[order]
    first = np.append(True, g[1:] != g[:-1])
    for d in np.unique(common[common > 0]).tolist():
        classes = np.cumsum(first | (common < d))
        parting = np.zeros(classes[-1] + 1, dtype=bool)
        parting[classes[common == d]] = True
        here = np.nonzero(parting[classes])[0]
        row = order[here]
        depth[row, many[row]] = d
        symbol[row, many[row]] = classes[here] + d * (n + 1)
        many[row] += 1
    return reach, depth, symbol


def _common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Symbols (``most`` at most) that each suffix of the array shares with the one before it."""
    padded = np.concatenate([text, np.zeros(most + 1, dtype=text.dtype)])
    out = np.zeros(len(order), dtype=np.int64)
    live = np.arange(1, len(order))
    for d in range(most):
        live = live[padded[order[live] + d] == padded[order[live - 1] + d]]
        if not len(live):
            break
        out[live] += 1
    return out


def covered_windows(group: np.ndarray, left: list[bytes], right: list[bytes], side: int) -> list[tuple[int, int, int]]:
    """``(row, least, most)``: windows of a row that take ``least`` to ``most``
    bytes of its left side (and the rest of ``side`` bytes of its right one) and
    that an earlier row of its group also has. Rows stand in the order of their
    places; ``left`` holds the bytes before the anchor in reverse."""
    lo, lc = _shared(left, group, side)
    ro, rc = _shared(right, group, side)
    l_reach, l_depth, l_symbol = _branches(group, lo, lc, side)
    r_reach, r_depth, r_symbol = _branches(group, ro, rc, side)
    rows = np.nonzero(l_reach + r_reach >= side)[0]  # others share no whole window
    if len(rows) < 2:
        return []
    # text of a row: left symbols from the outermost in, the anchor, right symbols, a separator
    ld, rd = l_depth[rows], r_depth[rows]
    l_many, r_many = (ld > 0).sum(1), (rd > 0).sum(1)
    size = l_many + r_many + 2
    begin = np.cumsum(size) - size + l_many  # the anchor's place
    codes = np.zeros(int(size.sum()), dtype=np.int64)
    codes[begin] = group[rows] * 4 + 2
    i, k = np.nonzero(ld)
    codes[begin[i] - 1 - k] = l_symbol[rows[i], k] * 4 + 1
    i, k = np.nonzero(rd)
    codes[begin[i] + 1 + k] = r_symbol[rows[i], k] * 4 + 3
    text = np.unique(codes, return_inverse=True)[1].reshape(-1) + 1
    order = np.array(suffix_array(text.tolist()), dtype=np.int64)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    # windows: how many bytes on the left -> where their symbols start, and how many there are
    w_row, w_left, w_size, w_before = [], [], [], []
    for before in range(side + 1):
        ok = np.nonzero((l_reach[rows] >= before) & (r_reach[rows] >= side - before))[0]
        if not len(ok):
            continue
        need_l = np.where(ld[ok] >= before, ld[ok], side + 1).argmin(1) + 1 if before else np.zeros(len(ok), np.int64)
        need = side - before
        need_r = np.where(rd[ok] >= need, rd[ok], side + 1).argmin(1) + 1 if need else np.zeros(len(ok), np.int64)
        w_row.append(ok)
        w_left.append(need_l)
        w_size.append(need_l + 1 + need_r)
        w_before.append(np.full(len(ok), before))
    if not w_row:
        return []
    w_row, w_left, w_size, w_before = (np.concatenate(x) for x in (w_row, w_left, w_size, w_before))
    start = rank[begin[w_row] - w_left]  # where the window's suffix stands in the array
    common = _common_prefixes(text, order, int(w_size.max()))
    interval = np.empty(len(start), dtype=np.int64)
    by_size = np.argsort(w_size, kind="stable")
    cuts = np.nonzero(np.diff(w_size[by_size], prepend=-1))[0]
    for a, b in zip(cuts, np.append(cuts[1:], len(by_size))):
        own = by_size[a:b]  # suffixes with so many symbols in common stand together
        interval[own] = np.cumsum(common < w_size[own[0]])[start[own]]
    key = (w_before * (int(w_size.max()) + 1) + w_size) * (len(order) + 1) + interval
    sort = np.argsort(key, kind="stable")
    key, r, before = key[sort], rows[w_row[sort]], w_before[sort]
    head = np.append(True, key[1:] != key[:-1])
    earliest = np.minimum.reduceat(r, np.nonzero(head)[0])[np.cumsum(head) - 1]
    hit = r > earliest
    out_row, out_before = r[hit], before[hit]
    order = np.lexsort((out_before, out_row))
    out_row, out_before = out_row[order], out_before[order]
    if not len(out_row):
        return []
    cut = np.append(True, (out_row[1:] != out_row[:-1]) | (out_before[1:] != out_before[:-1] + 1))
    a = np.nonzero(cut)[0]
    b = np.append(a[1:], len(out_row)) - 1
    return list(zip(out_row[a].tolist(), out_before[a].tolist(), out_before[b].tolist()))


_DEAL = "h long, key long, base int, doc_id long, tkey long, pos int, left binary, right binary"
_KINDS = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
_NAMES = [x.split()[0] for x in _DEAL.split(", ")]


def halves(side: int) -> tuple[int, int]:
    """Bytes that rows of one deal share, and what is left of ``side`` then."""
    shared = (side + 1) // 2
    return shared, side - shared


def _dealt(row: tuple, side: int) -> list[tuple]:
    """The one or two deals of a row (h, key, base, doc_id, tkey, pos, left, right)
    whose windows take ``side`` bytes of both sides together."""
    h, key, base, doc, tkey, pos, left, right = row
    shared, rest = halves(side)
    out = []
    if len(left) >= shared:
        out.append((h, _deal_key(key, b"l", left[:shared]), base + shared, doc, tkey, pos, left[shared:side], right[:rest]))
    if len(right) >= shared:
        out.append((h, _deal_key(key, b"r", right[:shared]), base, doc, tkey, pos, left[:rest], right[shared:side]))
    return out


def _deal_key(key: int, half: bytes, shared: bytes) -> int:
    return xxhash.xxh64_intdigest(b"%d%s" % (key, half) + shared) - (1 << 63)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], names=_NAMES)


def _resolve(dealt: DataFrame, side: int) -> DataFrame:
    """Covered spans (``h`` null, ``pos`` to ``key``) of all groups of a deal
    whose windows still take ``side`` bytes, and the next deal of large groups."""
    def spans(rows: list[tuple]) -> list[tuple]:
        ids: dict[tuple, int] = {}
        group = np.array([ids.setdefault(x[:2], len(ids)) for x in rows], dtype=np.int64)
        out = []
        for i, a, b in covered_windows(group, [x[6] for x in rows], [x[7] for x in rows], side):
            _, _, base, doc, tkey, pos, _, _ = rows[i]
            out.append((None, pos - base - a + LENGTH, None, doc, tkey, pos - base - b, None, None))
        return out

    def whole(rows: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        """Nothing is left of the sides: all but the first of a group are covered."""
        last = None
        for some in rows:
            out = []
            for x in some:
                if last and x[:2] == last[:2] and x[3:6] != last[3:6]:  # not a repeated row of the input
                    out.append((None, x[5] - x[2] + LENGTH, None, x[3], x[4], x[5] - x[2], None, None))
                last = x
            yield _batch(out)

    def groups(rows: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
        held, now, large, out = [], [], False, []   # whole groups, the group that is being read
        for some in rows:
            for x in some:
                if now and x[:2] != now[-1][:2]:
                    if len(now) > 1 and not large:
                        held += now
                    now, large = [], False
                    if len(held) >= SORTED_ROWS:
                        out += spans(held)
                        held = []
                if now and x[3:6] == now[-1][3:6]:
                    continue  # a repeated row of the input
                now.append(x)
                if large:
                    out += _dealt(x, side)
                elif len(now) > GROUP_ROWS:
                    large = True
                    for y in now:
                        out += _dealt(y, side)
                if large:
                    now = now[-1:]
            if len(out) >= SORTED_ROWS:
                yield _batch(out)
                out = []
        if len(now) > 1 and not large:
            held += now
        yield _batch(out + (spans(held) if held else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (list(zip(*(c.to_pylist() for c in b.columns))) for b in batches)
        yield from groups(rows) if side else whole(rows)
    return (dealt.repartition("h", "key").sortWithinPartitions("h", "key", F.col("doc_id").isNull(), "doc_id", "tkey", "pos")
            .mapInArrow(run, _DEAL))


def _contexts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first deal: bytes around the wanted anchors of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, tkey, text, asked in zip(*(c.to_pylist() for c in b.columns)):
                data = text.encode("utf-8")
                for a in asked:
                    p = a["pos"]
                    out += _dealt((a["h"], 0, 0, doc, tkey, p, data[max(0, p - SIDE):p][::-1], data[p + GRAM:p + GRAM + SIDE]), SIDE)
            yield _batch(out)
    asked = wanted.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("h", "pos")).alias("asked")).select(
        F.col("doc_id").alias("d"), F.col("tkey").alias("k"), "asked")
    once = keyed.join(asked, keyed["doc_id"].eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k")))
    return once.select("doc_id", "tkey", "t", "asked").mapInArrow(run, _DEAL)


def _per_doc(spans: DataFrame) -> DataFrame:
    """Ranges gathered by document (no more than its bytes)."""
    return spans.groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("begin", "stop")).alias("cut"))


def covered_spans(docs: DataFrame, column: str = "text") -> DataFrame:
    """``(doc_id, tkey, cut)``: byte ranges to remove, overlapping freely, up to
    two rows a document. Tables between steps are deleted after their last use."""
    prepare(docs.sparkSession)
    keyed = _keyed(docs, column)
    often = stored(_anchor_rows(keyed, False).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    found = stored(_anchor_rows(keyed, True).join(often, "h"))
    discard(often)
    classes = stored(found.groupBy("h", "around").agg(F.min(_order()).alias("first")))
    # all but the first of a class: every window around the anchor repeats
    equal = stored(_per_doc(found.join(classes, ["h", "around"]).where(_order() != F.col("first")).select(
        "doc_id", "tkey", F.greatest(F.col("pos") - SIDE, F.lit(0)).alias("begin"), (F.col("pos") + LENGTH).alias("stop"))))
    discard(found)
    many = classes.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h")
    wanted = stored(classes.join(many, "h").select("h", "first.doc_id", "first.tkey", "first.pos"))
    discard(classes)
    first_deal = dealt = stored(_contexts(keyed, wanted))  # the texts' shuffle ends here, before the deals' begins
    discard(wanted)
    side = SIDE
    found, out = [], equal
    while True:
        side = halves(side)[1]
        found.append(stored(_resolve(dealt, side)))
        if len(found) == 1:
            discard(first_deal)
        dealt = found[-1].where("h IS NOT NULL")
        if not side or dealt.isEmpty():
            break
    for f in found:
        out = out.unionByName(_per_doc(f.where("h IS NULL").select("doc_id", "tkey", F.col("pos").alias("begin"),
                                                                   F.col("key").cast("int").alias("stop"))))
    return out


def _merge(n: int, begins: list[int], stops: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(begins, stops)):
        b = min(b, n)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``
    (maximal removed runs), ``kept`` (the remaining bytes) and ``spans``.

    Null counts as empty. Texts under ``LENGTH`` bytes never change. Rows with
    equal ``doc_id`` and text are one document and get equal results; rows that
    share a ``doc_id`` with different texts are ordered by the text's hash; rows
    without an id come last. Other columns are ignored; an empty table gives no
    rows. Repeats are judged on the input, not on what is left of it.
    """
    per_doc = covered_spans(docs, column).groupBy("doc_id", "tkey").agg(F.flatten(F.collect_list("cut")).alias("cut")).select(
        F.col("doc_id").alias("d"), F.col("tkey").alias("k"), "cut")
    keyed = _keyed(docs, column)
    joined = keyed.join(per_doc, keyed["doc_id"].eqNullSafe(F.col("d")) & (F.col("tkey") == F.col("k")), "left").select(
        "doc_id", "t", "cut.begin", "cut.stop")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, text, begins, stops in zip(*(c.to_pylist() for c in b.columns)):
                data = text.encode("utf-8")
                cuts = _merge(len(data), begins or [], stops or [])
                at, parts = 0, []
                for x, y in cuts:
                    parts.append(data[at:x])
                    at = y
                parts.append(data[at:])
                out.append((doc, len(data), sum(y - x for x, y in cuts), len(cuts), b"".join(parts)))
            cols = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(),) * 4 + (pa.binary(),))],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digests(docs: DataFrame, column: str = "text") -> DataFrame:
    return remove_repeats(docs, column).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[tuple[int, bytes]]) -> dict[int, tuple[int, int, str]]:
    """The definition, for tests: ``(n_removed, n_spans, sha256)`` by id."""
    seen: set[bytes] = set()
    out = {}
    for doc, data in sorted(texts):
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            w = data[i:i + LENGTH]
            if w in seen:
                gone[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(w)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[doc] = sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()
    return out
