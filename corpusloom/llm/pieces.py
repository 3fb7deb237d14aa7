"""SentencePiece BPE encoding and decoding with byte offsets.

The model file's own parts drive everything: the compiled character map (a
double-array trie) normalises by longest prefix and records which source byte
every normalised byte came from; merges follow the piece scores; characters
without a piece become byte pieces. Because no piece of such a model holds a
word mark after another character, a text is encoded word by word, and each
task remembers the words it has met (a bounded memo that is emptied when
full). Every piece is projected back to a span of the original UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.base import bounded_pieces
from corpusloom.llm.common import extend_schema, prepare

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # piece types of the model format
MEMO_WORDS = 150_000
PIECE_BYTES = 1 << 20  # bytes of text that a task encodes at a time, at most (unless one text is longer)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) pairs of one protocol-buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7
    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled map (empty: identity)."""

    def __init__(self, blob: bytes = b""):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, dtype="<u4", count=size // 4, offset=4).tolist() if blob else []
        self.strings = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(source bytes consumed, replacement) at byte ``at``; one character stands for itself."""
        best = None
        if self.units:
            unit = self.units[0]
            node = (unit >> 10) << ((unit & 0x200) >> 6)
            for i in range(at, len(data)):
                node ^= data[i]
                unit = self.units[node]
                if unit & 0x800000FF != data[i]:
                    break
                node ^= (unit >> 10) << ((unit & 0x200) >> 6)
                if unit >> 8 & 1:
                    best = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if best:
            return best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])]
        lead = data[at]
        n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return n, data[at:at + n]


class PieceModel:
    """A BPE piece model, read from the bytes of its model file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict[int, int | bytes] = {}
        normal: dict[int, int | bytes] = {}
        for field, value in _fields(data):
            if field == 1:
                p = dict(_fields(value))
                self.pieces.append((p[1].decode("utf-8"), struct.unpack("<f", p.get(2, bytes(4)))[0], p.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normal = dict(_fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0):
            raise ValueError("only BPE models with the word mark in front are supported")
        if any(t in (USER, UNUSED) for _, _, t in self.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.byte_fallback = bool(trainer.get(35, 0))
        unknown = trainer.get(44, b" \xe2\x81\x87 ")
        self.charmap = CharacterMap(normal.get(2, b""))
        self.dummy_prefix = bool(normal.get(3, 1))
        self.squeeze = bool(normal.get(4, 1))
        self.escape = bool(normal.get(5, 1))
        self.ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
        self.score = {p: s for p, s, t in self.pieces if t == NORMAL}
        self.unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN), 0)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        self.surface = [b"" if t == CONTROL else unknown if t == UNKNOWN else bytes([int(p[3:5], 16)]) if t == BYTE
                        else p.replace(MARK, " ").encode("utf-8") for p, _, t in self.pieces]
        self.is_byte = [t == BYTE for _, _, t in self.pieces]
        # bytes of a piece in the normalised text
        self.width = np.array([1 if t == BYTE else len(p.encode("utf-8")) for p, _, t in self.pieces], dtype=np.int64)
        # bytes of a piece in an unmapped source text
        self.source_width = np.array([len(x) for x in self.surface], dtype=np.int64)
        by_word = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.words = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+" if by_word else r"(?s).+")
        # neighbouring characters that some piece holds: merges never cross any others
        self.joins = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.chunks = _Memo(self._encode_chunk)
        self.memo = _Memo(self._encode_word)

    # -- normalisation ----------------------------------------------------
    def plain(self) -> bool:
        return not self.charmap.units and not self.squeeze and self.escape

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its UTF-8 bytes (and its end)
        the source byte it came from."""
        data = text.encode("utf-8")
        mark = MARK.encode("utf-8")
        if self.plain():
            if not data:
                return "", np.zeros(1, dtype=np.int64)
            src = np.frombuffer(data, dtype=np.uint8)
            width = np.where(src == 0x20, 3, 1)
            align = np.repeat(np.arange(len(src)), width)
            head = np.zeros(3 * self.dummy_prefix, dtype=np.int64)
            return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK), np.concatenate([head, align, [len(src)]])
        at, n = 0, len(data)
        if self.squeeze:
            while at < n:
                used, to = self.charmap.longest(data, at)
                if to != b" ":
                    break
                at += used
        if at >= n:
            return "", np.zeros(1, dtype=np.int64)
        space = mark if self.escape else b" "
        out, align = bytearray(), []
        if self.dummy_prefix:
            out += space
            align += [at] * len(space)
        after_space = self.squeeze
        while at < n:
            used, to = self.charmap.longest(data, at)
            if after_space:
                to = to.lstrip(b" ")
            for byte in to:
                add = space if byte == 0x20 else bytes([byte])
                out += add
                align += [at] * len(add)
            if to:
                after_space = self.squeeze and to.endswith(b" ")
            at += used
        if self.squeeze:
            while out.endswith(space):
                del out[-len(space):]
                at = align[-len(space)]
                del align[-len(space):]
        return out.decode("utf-8"), np.array([*align, at], dtype=np.int64)

    # -- encoding ---------------------------------------------------------
    def _encode_word(self, word: str) -> bytes:
        """Ids of a word (32 bits each): its chunks between characters that no piece joins."""
        joins, chunks = self.joins, self.chunks
        cut = [i for i in range(1, len(word)) if word[i - 1:i + 1] not in joins]
        if not cut:
            return self._encode_chunk(word)
        return b"".join([chunks[word[a:b]] for a, b in zip([0, *cut], [*cut, len(word)])])

    def _encode_chunk(self, word: str) -> bytes:
        out = array("i")
        if len(word) == 1 and word in self.ids:
            out.append(self.ids[word])
            return out.tobytes()
        for part in (_merge_short if len(word) <= 48 else _merge_long)(word, self.score):
            i = self.ids.get(part)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out.extend(self.bytes[b] for b in part.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out.tobytes()

    def encode(self, text: str) -> np.ndarray:
        return self._ids(self.normalize(text)[0])

    def _ids(self, normalized: str) -> np.ndarray:
        ids = np.frombuffer(b"".join(map(self.memo.__getitem__, self.words.findall(normalized))), dtype=np.int32)
        if not self.byte_fallback and len(ids):  # neighbouring unknown characters are one piece
            ids = ids[np.concatenate([[True], (ids[1:] != self.unknown) | (ids[:-1] != self.unknown)])]
        return ids

    def encode_spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each the first and the end byte of its source span."""
        if self.plain() and MARK not in text and self.byte_fallback:
            # blanks are one byte on either side, so the widths of the pieces tell the spans
            if not text:
                return (np.zeros(0, np.int32),) * 3
            ids = self._ids((MARK if self.dummy_prefix else "") + text.replace(" ", MARK))
            end = np.cumsum(self.source_width[ids]) - int(self.dummy_prefix)
            return ids, np.maximum(end - self.source_width[ids], 0), end
        normalized, align = self.normalize(text)
        ids = self._ids(normalized)
        if not self.byte_fallback and (ids == self.unknown).any():
            raise ValueError("spans need a model with byte pieces")
        end = np.cumsum(self.width[ids])
        return ids, align[end - self.width[ids]], align[end]

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        strip = self.dummy_prefix or self.squeeze
        parts = list(map(surface.__getitem__, ids))
        for k, i in enumerate(ids):
            if not parts[k]:
                continue  # a control piece says nothing
            kind = self.pieces[i][2]
            if strip and kind == NORMAL and parts[k].startswith(b" "):
                parts[k] = parts[k][1:]
                if not parts[k] and self.squeeze:
                    continue
            break
        try:
            return b"".join(parts).decode("utf-8")
        except UnicodeDecodeError:
            pass
        out, run = [], bytearray()
        for k, i in enumerate([*ids, -1]):
            if i >= 0 and self.is_byte[i]:
                run += parts[k]
                continue
            while run:  # byte pieces: whole characters, each byte that belongs to none becomes U+FFFD
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:n]).decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        n = 0
                if not n:
                    out.append("�")
                del run[:n or 1]
            if i >= 0:
                out.append(parts[k].decode("utf-8"))
        return "".join(out)


class _Memo(dict):
    """Word to ids in two generations: when the young one is full it becomes
    the old one, and words met again move back. Memory stays bounded, frequent
    words stay, and every new word can be remembered."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _merge_short(word: str, score: dict[str, float]) -> list[str]:
    """Best pair first, leftmost on ties; for short words a list is quickest."""
    parts = list(word)
    low = float("-inf")
    pairs = [score.get(a + b, low) for a, b in zip(parts, parts[1:])]
    while pairs and (best := max(pairs)) > low:
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = score.get(parts[i - 1] + parts[i], low)
        if i < len(pairs):
            pairs[i] = score.get(parts[i] + parts[i + 1], low)
    return parts


def _merge_long(word: str, score: dict[str, float]) -> list[str]:
    """The same order of merges with a heap and a linked list: n log n."""
    parts: list[str] = list(word)
    n = len(parts)
    prev, nxt = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[float, int, int, int]] = []

    def offer(a: int, b: int) -> None:
        if a >= 0 and b >= 0 and (s := score.get(parts[a] + parts[b])) is not None:
            heapq.heappush(heap, (-s, a, b, len(parts[a]) + len(parts[b])))
    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, a, b, size = heapq.heappop(heap)
        if not parts[a] or not parts[b] or len(parts[a]) + len(parts[b]) != size or nxt[a] != b:
            continue
        parts[a] += parts[b]
        parts[b] = ""
        nxt[a] = nxt[b]
        if nxt[b] >= 0:
            prev[nxt[b]] = a
        offer(prev[a], a)
        offer(a, nxt[a])
    return [p for p in parts if p]


@lru_cache(maxsize=2)
def _model(data: bytes) -> PieceModel:
    return PieceModel(data)


def encode_documents(docs: DataFrame, model_path: str, column: str = "text", *,
                     ids: str = "ids", begins: str = "begins", ends: str = "ends", decoded: str = "decoded") -> DataFrame:
    """``docs`` without ``column`` plus the piece ids, the source span of every
    piece (``begins``, ``ends``: byte offsets in the UTF-8 text) and the text
    that decoding the ids gives.

    Null counts as empty; an empty text has no pieces; repeated rows are
    encoded each; no begin or end id is added and nothing is sampled. The four
    new names must not be columns of ``docs`` (ValueError). ``model_path`` is
    read on the driver (a model file has a fixed size, about half a megabyte).
    """
    prepare(docs.sparkSession)
    rest = [c for c in docs.columns if c != column]
    taken = {c.lower() for c in rest} & {c.lower() for c in (ids, begins, ends, decoded)}
    if taken:
        raise ValueError(f"already columns of the table: {sorted(taken)}")
    with open(model_path, "rb") as f:
        data = f.read()
    slim = docs.select(*rest, column)
    schema = extend_schema(T.StructType(slim.schema.fields[:-1]), (ids, T.ArrayType(T.IntegerType())),
                           (begins, T.ArrayType(T.IntegerType())), (ends, T.ArrayType(T.IntegerType())),
                           (decoded, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(data)
        for b in (p for whole in batches for p in bounded_pieces(whole, column, PIECE_BYTES)):
            got = [model.encode_spans(t or "") for t in b.column(len(rest)).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(g[0]) for g in got], dtype=np.int64)])
            lists = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(
                np.concatenate([np.zeros(0, np.int32), *(g[k].astype(np.int32) for g in got)]))) for k in range(3)]
            texts = pa.array([model.decode(g[0].tolist()) for g in got], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *lists, texts], names=schema.names)
    return slim.mapInArrow(run, schema)


def digest_columns() -> list[Column]:
    """``ids_sha256``, ``decoded_sha256`` and ``n_span_bytes`` (source bytes that
    the spans cover) of encoded rows."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return [sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
            sha(F.col("decoded")).alias("decoded_sha256"),
            F.coalesce(F.get("ends", F.size("ends") - 1) - F.get("begins", F.lit(0)), F.lit(0)).cast("long").alias("n_span_bytes")]


def digests(docs: DataFrame, model_path: str, column: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digest columns per row."""
    enc = encode_documents(docs.select("doc_id", F.col(column).alias("text")), model_path, "text")
    return enc.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), *digest_columns())
