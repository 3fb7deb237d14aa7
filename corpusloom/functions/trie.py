"""Greedy longest-match byte tokenizer over a text vocabulary.

Vocabulary file lines are ``id literal n_bytes`` where the literal is a
Python string or bytes literal; its UTF-8 length must equal ``n_bytes``.
Encoding walks the UTF-8 bytes and at each position takes the longest
vocabulary entry that matches (tokens are looked up by length, longest
first). Decoding stops at id 0; token bytes wait until they are valid UTF-8, and
what never becomes valid ends the text.
"""

from __future__ import annotations

import ast
import itertools
import re

import numpy as np
import pyarrow as pa

from corpusloom.functions.base import Memo, Tokenizer, decode_pieces, packed, strings_to_bytes, unpacked_rows


VOCAB_LINE = re.compile(r"(\d+) (.*) (\d+)", re.S)


def parse_vocab_line(line: str) -> tuple[int, bytes, int]:
    """One ``id literal n_bytes`` line → (id, token bytes, n_bytes)."""
    m = VOCAB_LINE.fullmatch(line.strip("\r\n"))
    if m is None:
        raise ValueError(f"not a vocabulary line: {line!r}")
    value = ast.literal_eval(m[2].strip())
    if not isinstance(value, (str, bytes)):
        raise ValueError(f"vocabulary literal is neither str nor bytes: {line!r}")
    token = value.encode("utf-8") if isinstance(value, str) else value
    if len(token) != int(m[3]):
        raise ValueError(f"length mismatch for id {m[1]}: {len(token)} != {m[3]}")
    return int(m[1]), token, len(token)


def format_vocab_line(idx: int, tok: bytes) -> str:
    try:
        lit = repr(tok.decode("utf-8"))
    except UnicodeDecodeError:
        lit = repr(tok)
    return f"{idx} {lit} {len(tok)}"


def _automaton(vocab: dict[bytes, int]):
    """Aho-Corasick automaton over the tokens (a byte is one Latin-1 character), or
    False where the library is absent: the walk gives the same ids."""
    try:
        import ahocorasick
    except ImportError:
        return False
    out = ahocorasick.Automaton()
    for token, tid in vocab.items():
        if token:
            out.add_word(token.decode("latin-1"), (len(token), tid))
    if not len(out):
        return False
    out.make_automaton()
    return out


class TrieTokenizer(Tokenizer):
    name = "trie"

    def __init__(self, vocab: dict[bytes, int], eod: int | None = 65532):
        self.encoder = dict(vocab)
        self.decoder = {i: t for t, i in self.encoder.items()}
        self.max_len = max((len(t) for t in self.encoder), default=1)
        self._prefixes = {t[:j] for t in self.encoder for j in range(1, len(t) + 1)}
        self.eod = eod
        self.vocab_size = max(self.decoder, default=0) + 1
        single = np.full(256, -1, dtype=np.int64)
        for t, i in self.encoder.items():
            if len(t) == 1:
                single[t[0]] = i
        self._single = single
        self._only_single = self.max_len == 1
        self._automaton = None  # built where it is used
        # no token reaches over a space: texts fall apart there into words, which recur
        self._by_word = b" " in self.encoder and all(b" " not in t for t in self.encoder if len(t) > 1)
        self._packed = Memo(self._encode_word)

    def _encode_word(self, word: str) -> bytes:
        return packed(self._encode_bytes(word.encode("utf-8")))

    @classmethod
    def from_lines(cls, lines, eod: int | None = 65532) -> "TrieTokenizer":
        vocab = {}
        for ln in lines:
            if ln.strip():
                i, t, _ = parse_vocab_line(ln.rstrip("\n"))
                vocab[t] = i
        return cls(vocab, eod)

    def _walk(self, data: bytes) -> list[int]:
        """Walk over the set of token prefixes: extend while the piece is a prefix
        of some token, remember the longest piece that is a token."""
        out = []
        enc, pre, maxl = self.encoder, self._prefixes, self.max_len
        i, n = 0, len(data)
        while i < n:
            best, end = -1, i
            j, lim = i + 1, min(n, i + maxl)
            while j <= lim:
                piece = data[i:j]
                if piece not in pre:
                    break
                tid = enc.get(piece)
                if tid is not None:
                    best, end = tid, j
                j += 1
            if best < 0:
                raise ValueError(f"byte 0x{data[i]:02x} is not in the vocabulary")
            out.append(best)
            i = end
        return out

    def _encode_bytes(self, data: bytes) -> list[int]:
        """Ids by the automaton over the vocabulary; its leftmost longest matches
        are the greedy ones as long as they lie end to end."""
        if self._automaton is None:
            self._automaton = _automaton(self.encoder)
        if not self._automaton:
            return self._walk(data)
        out, at = [], 0
        for last, (size, tid) in self._automaton.iter_long(data.decode("latin-1")):
            if last + 1 - size != at:
                break
            out.append(tid)
            at = last + 1
        return out if at == len(data) else self._walk(data)

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None, "_packed": None}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._packed = Memo(self._encode_word)

    def encode_batch(self, texts):
        return [self._encode_bytes(t.encode("utf-8")) for t in texts]

    def encode_arrow(self, texts: pa.Array) -> pa.Array:
        if self._only_single:
            offs, data = strings_to_bytes(texts)
            vals = self._single[data]
            if (vals < 0).any():
                bad = int(data[np.flatnonzero(vals < 0)[0]])
                raise ValueError(f"byte 0x{bad:02x} is not in the vocabulary")
            return pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(vals.astype(np.int32)))
        if self._by_word:
            space, known = packed([self.encoder[b" "]]), self._packed.__getitem__
            return unpacked_rows([space.join(map(known, (t or "").split(" "))) for t in texts.to_pylist()])
        return super().encode_arrow(texts)

    def decode_batch(self, ids):
        known = self.decoder
        return [decode_pieces([known.get(i, b"") for i in itertools.takewhile(bool, row)]) for row in ids]


def byte_vocab_lines(offset: int = 1) -> list[str]:
    """Vocabulary with the 256 single bytes at ids ``offset..offset+255``."""
    return [format_vocab_line(b + offset, bytes([b])) for b in range(256)]
