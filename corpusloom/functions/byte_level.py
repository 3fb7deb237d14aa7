"""Single-byte vocabulary (T2 with the 256-byte vocabulary, T9 decode).

Id of a byte ``b`` is ``b + offset`` (offset 1: ids 1..256 for bytes
0x00..0xFF, the layout of a text vocabulary whose first 256 entries are the
single bytes). Encoding is a zero-copy numpy view of the UTF-8 buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from corpusloom.functions.base import Tokenizer, list_offsets, strings_to_bytes


class ByteTokenizer(Tokenizer):
    name = "byte"

    def __init__(self, eod: int | None = 65532, offset: int = 1, vocab_size: int | None = None):
        self.eod = eod
        self.offset = offset
        self.vocab_size = vocab_size if vocab_size is not None else max(256 + offset, (eod or 0) + 1)

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        offs, data = strings_to_bytes(texts)
        vals = data.astype(np.int32) + np.int32(self.offset)
        return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(vals))

    def encode_batch(self, texts):
        return [[b + self.offset for b in t.encode("utf-8")] for t in texts]

    def _to_bytes(self, ids) -> bytes:
        out = bytearray()
        for i in ids:
            b = i - self.offset
            if 0 <= b < 256:
                out.append(b)
        return bytes(out)

    def decode_batch(self, ids):
        return [self._to_bytes(x).decode("utf-8", errors="replace") for x in ids]

    def decode_arrow(self, ids: pa.Array) -> pa.Array:
        offs = list_offsets(ids)
        vals = np.asarray(ids.flatten(), dtype=np.int64) - self.offset
        keep = (vals >= 0) & (vals < 256)
        if keep.all():
            data = vals.astype(np.uint8)
            new_offs = offs
        else:
            kc = np.concatenate(([0], np.cumsum(keep)))
            data = vals[keep].astype(np.uint8)
            new_offs = kc[offs]
        binarr = pa.BinaryArray.from_buffers(pa.binary(), len(new_offs) - 1,
                                             [None, pa.py_buffer(new_offs.astype(np.int32).tobytes()),
                                              pa.py_buffer(data.tobytes())])
        try:
            return binarr.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([v.decode("utf-8", errors="replace") for v in binarr.to_pylist()],
                            type=pa.string())
