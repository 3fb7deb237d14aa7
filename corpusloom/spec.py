"""Job parameters (U2): tokenizer and corpus specifications.

``TokenizerSpec.build()`` replaces the reference's builder dispatch; the
tokenizer object it returns is shipped to tasks with the job closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from corpusloom.functions.base import Tokenizer

# Fixed value: end-of-document id of the text-vocabulary byte family.
RWKV_EOD = 65532


@dataclass
class TokenizerSpec:
    """``kind``: ``byte`` | ``null`` | ``rwkv`` (text vocabulary, greedy
    longest match) | ``gpt2`` (vocab.json + merges.txt) | ``wordpiece`` |
    ``hf`` (tokenizer.json or a folder) | ``sentencepiece``.

    For ``hf``, ``tokenizer_model`` takes precedence over ``vocab_file``;
    ``tokenizer_kwargs`` is a flat list of key/value pairs."""

    kind: str = "byte"
    vocab_file: str | None = None
    merges_file: str | None = None
    tokenizer_model: str | None = None
    vocab_size: int | None = None
    eod: int | None = None
    variant: str = "plain"
    special_tokens: list[str] = field(default_factory=list)
    tokenizer_kwargs: list[str] = field(default_factory=list)

    def kwargs(self) -> dict[str, str]:
        if len(self.tokenizer_kwargs) % 2:
            raise ValueError("tokenizer kwargs must be entered in pairs (key value ...)")
        it = iter(self.tokenizer_kwargs)
        return dict(zip(it, it))

    def build(self) -> Tokenizer:
        kw = self.kwargs()
        if self.kind == "byte":
            from corpusloom.functions.byte_level import ByteTokenizer
            return ByteTokenizer(eod=RWKV_EOD if self.eod is None else self.eod)
        if self.kind == "null":
            from corpusloom.functions.null import NullTokenizer
            if self.vocab_size is None:
                raise ValueError("the whitespace-integer tokenizer needs vocab_size")
            return NullTokenizer(self.vocab_size)
        if self.kind == "rwkv":
            from corpusloom.functions.trie import TrieTokenizer
            with open(self.vocab_file, encoding="utf-8") as f:
                return TrieTokenizer.from_lines(f, eod=RWKV_EOD if self.eod is None else self.eod)
        if self.kind == "gpt2":
            from corpusloom.functions.bpe import Gpt2BpeTokenizer
            return Gpt2BpeTokenizer.from_files(self.vocab_file, self.merges_file, self.special_tokens or None)
        if self.kind == "wordpiece":
            from corpusloom.functions.wordpiece import WordPieceTokenizer
            with open(self.vocab_file, encoding="utf-8") as f:
                tok = WordPieceTokenizer.from_lines(list(f), lower=kw.get("lower", "true") == "true")
            return tok.add_bert_specials(int(kw.get("vocab_extra_ids", "0")))
        if self.kind == "hf":
            from corpusloom.functions.adapters import HFTokenizerFile
            path = self.tokenizer_model or self.vocab_file
            if path is None:
                raise ValueError("the tokenizer-file family needs tokenizer_model or vocab_file")
            return HFTokenizerFile(path)
        if self.kind == "sentencepiece":
            from corpusloom.functions.adapters import SentencePieceTokenizer
            return SentencePieceTokenizer(self.tokenizer_model, self.variant, self.special_tokens)
        raise NotImplementedError(f"tokenizer kind {self.kind!r}")


@dataclass
class CorpusSpec:
    """Parameters of ``build_corpus`` (Python API defaults, Q17)."""

    input: str
    output_prefix: str
    tokenizer: TokenizerSpec = field(default_factory=TokenizerSpec)
    json_keys: list[str] = field(default_factory=lambda: ["text"])
    input_format: str = "jsonl"        # or "parquet" (S9)
    split_sentences: bool = False
    keep_newlines: bool = False
    abbreviations: list[str] = field(default_factory=list)  # P6 rule parameter for the corpus language
    append_eod: bool = True
    partitions: int = 1
    keep_sequential_samples: bool = False
    merge_partitions: bool = True
    per_file: bool = False             # R4: one dataset per input file
    quarantine_path: str | None = None
    dtype: str | None = None
