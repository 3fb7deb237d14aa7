"""GPT-2 byte-level BPE.

Text → pieces (GPT-2 pattern, P12) → each piece's UTF-8 bytes mapped to
printable symbols → repeated merge of the lowest-ranked adjacent pair →
symbols looked up in the vocabulary (unknown → 0). Special tokens get ids
after the vocabulary. Every task keeps a memo of encoded pieces; the
cluster-wide memo is the dictionary strategy in ``dictionary.py``.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa

from corpusloom.functions.base import Memo, Tokenizer, packed, unpacked_rows
from corpusloom.operators.text import GPT2_PATTERN


def byte_symbols() -> dict[int, str]:
    """Reversible byte → printable character map of byte-level BPE.

    Bytes that are printable Latin-1 characters ('!'..'~', '¡'..'¬',
    '®'..'ÿ') stand for themselves; the remaining bytes, in increasing order,
    take the code points 256, 257, ...
    """
    printable = [b for b in range(256)
                 if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    table = {b: chr(b) for b in printable}
    nxt = 256
    for b in range(256):
        if b not in table:
            table[b] = chr(nxt)
            nxt += 1
    return table


class Gpt2BpeTokenizer(Tokenizer):
    name = "gpt2bpe"

    def __init__(self, encoder: dict[str, int], merges: list[tuple[str, str]],
                 special_tokens: list[str] | None = None, eod_token: str = "<|endoftext|>"):
        self.encoder = dict(encoder)
        self.decoder = {v: k for k, v in self.encoder.items()}
        self.ranks = {tuple(m): i for i, m in enumerate(merges)}
        self.merges = [tuple(m) for m in merges]
        self.byte_enc = byte_symbols()
        self.byte_dec = {v: k for k, v in self.byte_enc.items()}
        self.special = {t: len(self.encoder) + i for i, t in enumerate(special_tokens or [])}
        self.special_dec = {v: k for k, v in self.special.items()}
        self.vocab_size = len(self.encoder) + len(self.special)
        self.eod = self.encoder.get(eod_token, self.special.get(eod_token))
        self._memos()
        self._pat = None

    def _memos(self) -> None:
        self._memo = Memo(self._encode_piece)
        self._packed = Memo(lambda piece: packed(self._encode_piece(piece)))

    @classmethod
    def from_files(cls, vocab_json: str, merges_txt: str, special_tokens=None):
        """``vocab.json`` + ``merges.txt`` (first line is a header, the
        empty piece after the final newline is dropped)."""
        with open(vocab_json, encoding="utf-8") as f:
            encoder = json.load(f)
        with open(merges_txt, encoding="utf-8") as f:
            lines = f.read().split("\n")[1:-1]
        merges = [tuple(ln.split()) for ln in lines]
        return cls(encoder, merges, special_tokens)

    def __getstate__(self):
        d = dict(self.__dict__)
        d["_pat"] = None
        del d["_memo"], d["_packed"]
        return d

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._memos()

    @property
    def pattern(self):
        if self._pat is None:
            import regex
            self._pat = regex.compile(GPT2_PATTERN)
        return self._pat

    def bpe(self, symbols: str) -> list[str]:
        """Symbols after all merges, lowest rank first and, for one rank, from left
        to right. Neighbours are a linked list, mergeable pairs wait in a heap
        by (rank, position): O(n log n) for a piece of n bytes. The pairs of one
        rank are taken together, so that a merge of an earlier rank that they
        bring about comes after them, whatever the order of the merge list."""
        word, ranks, heap = list(symbols), self.ranks, []
        right = list(range(1, len(word) + 1))
        left = list(range(-1, len(word) - 1))
        for i in range(len(word) - 1):
            rank = ranks.get((word[i], word[i + 1]))
            if rank is not None:
                heap.append((rank, i))
        heapify(heap)
        while heap:
            now, touched = heap[0][0], []
            pair = self.merges[now]
            while heap and heap[0][0] == now:
                i = heappop(heap)[1]
                j = right[i]
                if j >= len(word) or (word[i], word[j]) != pair:
                    continue  # one of the two is part of another symbol by now
                word[i], word[j] = pair[0] + pair[1], None
                right[i] = right[j]
                if right[j] < len(word):
                    left[right[j]] = i
                touched.append(i)
            for i in touched:
                if word[i] is None:
                    continue
                for a in (left[i], i):
                    b = right[a] if a >= 0 else len(word)
                    if b < len(word) and (rank := ranks.get((word[a], word[b]))) is not None:
                        heappush(heap, (rank, a))
        return [s for s in word if s is not None]

    def _encode_piece(self, piece: str) -> list[int]:
        syms = "".join(self.byte_enc[b] for b in piece.encode("utf-8"))
        return [self.special[s] if s in self.special else self.encoder.get(s, 0) for s in self.bpe(syms)]

    def encode_piece(self, piece: str) -> list[int]:
        return self._memo[piece]

    def encode_batch(self, texts):
        memo = self._memo
        return [[i for piece in self.pattern.findall(t) for i in memo[piece]] for t in texts]

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        find, known = self.pattern.findall, self._packed.__getitem__
        return unpacked_rows([b"".join(map(known, find(t or ""))) for t in texts.to_pylist()])

    def encode_pieces_arrow(self, pieces: pa.Array) -> pa.Array:
        """Encode strings that are already single pieces (dictionary strategy)."""
        known = self._packed
        return unpacked_rows([known[p] if p is not None else b"" for p in pieces.to_pylist()])

    def decode_batch(self, ids):
        out = []
        for row in ids:
            text = "".join(self.special_dec.get(i) or self.decoder.get(i, "") for i in row)
            data = bytearray(self.byte_dec[c] for c in text if c in self.byte_dec)
            out.append(data.decode("utf-8", errors="replace"))
        return out


class PieceEncoder(Tokenizer):
    """Adapter: treat every input string as one pre-tokenized piece."""

    name = "pieces"

    def __init__(self, bpe: Gpt2BpeTokenizer):
        self.bpe = bpe
        self.eod = bpe.eod
        self.vocab_size = bpe.vocab_size

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        return self.bpe.encode_pieces_arrow(texts)
