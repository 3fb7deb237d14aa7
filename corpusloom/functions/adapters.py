"""Adapters for installed tokenizer packages (T5 SentencePiece, T6
``tokenizers`` files). The model file is opened once per Python worker; Spark
ships only its path, so the model must sit on storage every executor reads.
"""

from __future__ import annotations

import json
import os

import pyarrow as pa

from corpusloom.functions.base import Tokenizer

# End-of-document candidates of tokenizer files, in order.
EOD_CANDIDATES = ["<|end_of_text|>", "<|endoftext|>"]
GLM_PREFIX = ["[gMASK]", "sop"]


class HFTokenizerFile(Tokenizer):
    """A ``tokenizer.json`` (or a folder with one and
    ``tokenizer_config.json``). ``encode_batch`` of the ``tokenizers`` package
    runs per Arrow batch. Folders that need custom code are not executed."""

    name = "hf"

    def __init__(self, path: str):
        self.path = path
        tok = self._load()
        vocab = tok.get_vocab(with_added_tokens=True)
        self.vocab_size = tok.get_vocab_size(with_added_tokens=True)
        self.eod = None
        if os.path.isdir(path):
            cfg_path = os.path.join(path, "tokenizer_config.json")
            cfg = json.load(open(cfg_path, encoding="utf-8")) if os.path.exists(cfg_path) else {}
            eos = cfg.get("eos_token")
            if isinstance(eos, dict):
                eos = eos.get("content")
            self.eod = vocab.get(eos) if eos else None
            pad = cfg.get("pad_token")
            if isinstance(pad, dict):
                pad = pad.get("content")
            self.pad = vocab.get(pad) if pad else self.eod
        else:
            for cand in EOD_CANDIDATES:
                if cand in vocab:
                    self.eod = vocab[cand]
                    break
            else:
                self.eod = -1
        self._tok = None

    def _load(self):
        from tokenizers import Tokenizer as _T
        f = os.path.join(self.path, "tokenizer.json") if os.path.isdir(self.path) else self.path
        return _T.from_file(f)

    def __getstate__(self):
        d = dict(self.__dict__)
        d["_tok"] = None
        return d

    @property
    def tok(self):
        if self._tok is None:
            self._tok = self._load()
        return self._tok

    def encode_batch(self, texts):
        return [e.ids for e in self.tok.encode_batch(list(texts), add_special_tokens=False)]

    def decode_batch(self, ids):
        return self.tok.decode_batch([list(x) for x in ids], skip_special_tokens=False)


class SentencePieceTokenizer(Tokenizer):
    """T5 family around the ``sentencepiece`` package.

    ``variant``: ``plain`` (b), ``special`` (a: special tokens are split out
    before encoding), ``chatglm`` (c: ``[gMASK] sop`` prefix), ``llama2``
    (d: BOS first).
    """

    name = "sentencepiece"

    def __init__(self, model_file: str, variant: str = "plain", special_tokens: list[str] | None = None,
                 add_bos: bool | None = None, add_eos: bool = False):
        self.model_file = model_file
        self.variant = variant
        self._sp = None
        sp = self.sp
        self.special_tokens = list(special_tokens or [])
        base = sp.get_piece_size()
        self.special_ids = {t: base + i for i, t in enumerate(self.special_tokens)}
        self.vocab_size = base + len(self.special_tokens)
        self.bos = sp.bos_id()
        self.eod = sp.eos_id()
        self.add_bos = (variant == "llama2") if add_bos is None else add_bos
        self.add_eos = add_eos
        if variant == "chatglm":
            self.prefix = [self.special_ids.get(t, sp.piece_to_id(t)) for t in GLM_PREFIX]
        else:
            self.prefix = []

    def __getstate__(self):
        d = dict(self.__dict__)
        d["_sp"] = None
        return d

    @property
    def sp(self):
        if self._sp is None:
            import sentencepiece as spm
            self._sp = spm.SentencePieceProcessor(model_file=self.model_file)
        return self._sp

    def _encode_one(self, text: str) -> list[int]:
        if self.variant == "special" and self.special_tokens:
            import re
            pat = "(" + "|".join(re.escape(t) for t in self.special_tokens) + ")"
            ids = []
            for part in re.split(pat, text):
                if part in self.special_ids:
                    ids.append(self.special_ids[part])
                elif part:
                    ids.extend(self.sp.encode(part))
        else:
            ids = self.sp.encode(text)
        if self.add_bos:
            ids = [self.bos] + ids
        if self.add_eos:
            ids = ids + [self.eod]
        return self.prefix + ids

    def encode_batch(self, texts):
        return [self._encode_one(t) for t in texts]

    def decode_batch(self, ids):
        inv = {v: k for k, v in self.special_ids.items()}
        out = []
        for row in ids:
            parts, cur = [], []
            for i in row:
                if i in inv:
                    if cur:
                        parts.append(self.sp.decode(cur))
                        cur = []
                    parts.append(inv[i])
                else:
                    cur.append(i)
            if cur:
                parts.append(self.sp.decode(cur))
            out.append("".join(parts))
        return out
