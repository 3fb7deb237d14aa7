"""Text preparation as JVM expressions.

* P5  long-text slicing into fixed windows of code points;
* P6  rule-based sentence split (the statistical Punkt model is not
      available here, so only the rule form is offered, with no parity claim);
* P7  identity split (document level);
* P11 WordPiece text cleaning (control characters, whitespace, CJK spacing);
* P12 GPT-2 pre-tokenization with the ``(?U)`` flag for Unicode classes;
* P13 whitespace tokenization;
* P14 detokenized-English clean-up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
# Characters Python's str.strip()/split() treat as whitespace.
PY_WS = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# Slice size applied before sentence splitting.
MAX_SLICE_CHARS = 1_000_000
# Whitespace class used by the sentence rule; written out so that Java regex
# and RE2 agree (their \s differ on U+000B).
WS = r"[\t\n\f\r ]"
# A sentence: text up to a run of . ! ? that is followed by whitespace or the
# end, plus that whitespace. Every character belongs to exactly one match
# (an empty match can only occur at the end and is dropped). Written with
# character-class loops only, so Java's matcher does not recurse per
# character on long texts.
SENTENCE_PATTERN = (r"[^.!?]*(?:[.!?]+[^.!?\t\n\f\r ][^.!?]*)*[.!?]*" + WS + r"*")
# The same matches in Java, whose matcher recurses once per round of a group
# unless the group is possessive ("1.2.3..." of some 1,500 dots ends the stack).
# What follows the group always matches, so it never has to give a round back.
_JAVA_SENTENCE_PATTERN = SENTENCE_PATTERN.replace(")*", ")*+")
# GPT-2 pre-tokenization pattern.
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Detokenization clean-up replacements, applied in this order.
CLEANUP_REPLACEMENTS = [(" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
                        (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"),
                        (" 've", "'ve"), (" 're", "'re")]
# CJK ideograph blocks that WordPiece surrounds with spaces.
CJK_RANGES = [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2A6DF), (0x2A700, 0x2B73F),
              (0x2B740, 0x2B81F), (0x2B820, 0x2CEAF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F)]
# ---------------------------------------------------------------------------


def slice_text(text: Column, n: int = MAX_SLICE_CHARS) -> Column:
    """P5: windows of ``n`` code points; the empty string gives no window."""
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / n).cast("int")),
                    lambda i: F.substring(text, i * n + 1, n)))


def _strip_ws(s: Column) -> Column:
    return F.regexp_replace(s, f"^{WS}+|{WS}+$", "")


# Private-use character that stands in for the dot of a known abbreviation
# while sentences are cut.
_ABBR_MARK = "\uE000"


def split_sentences(text: Column, keep_newlines: bool = False,
                    abbreviations: list[str] | None = None) -> Column:
    """Sentences of one text (no empty sentence). With ``keep_newlines``
    the whitespace after a sentence end stays with that sentence. A dot that
    ends one of ``abbreviations`` (a per-language parameter, e.g. ``["Dr",
    "e.g"]``) does not end a sentence."""
    if abbreviations:
        import re
        alt = "|".join(re.escape(a) for a in sorted(abbreviations, key=len, reverse=True))
        text = F.regexp_replace(text, f"(?<![\\p{{L}}\\p{{N}}])({alt})\\.", "$1" + _ABBR_MARK)
    pieces = F.regexp_extract_all(text, F.lit(_JAVA_SENTENCE_PATTERN), 0)
    if abbreviations:
        pieces = F.transform(pieces, lambda x: F.replace(x, F.lit(_ABBR_MARK), F.lit(".")))
    if not keep_newlines:
        pieces = F.transform(pieces, _strip_ws)
    return F.filter(pieces, lambda s: F.length(_strip_ws(s)) > 0)


def split_values(values: Column, keep_newlines: bool = False, n: int = MAX_SLICE_CHARS,
                 abbreviations: list[str] | None = None) -> Column:
    """Sentence mode over a key's list of texts: slice each text (P5), split
    each slice (P6), flatten. A missing / null / empty value gives ``[]``."""
    per_text = F.transform(values, lambda t: F.flatten(
        F.transform(slice_text(t, n), lambda s: split_sentences(s, keep_newlines, abbreviations))))
    return F.flatten(per_text)


def identity_split(text: Column) -> Column:
    """The document is one sentence."""
    return F.array(text)


def pretokenize_gpt2(text: Column) -> Column:
    """GPT-2 pieces; concatenating them gives the text back."""
    return F.regexp_extract_all(text, F.lit("(?U)" + GPT2_PATTERN), 0)


def whitespace_tokenize(text: Column) -> Column:
    """Python ``str.split()``: runs of Unicode whitespace, including
    U+001C..U+001F, and no empty pieces."""
    return F.filter(F.split(text, PY_WS + "+"), lambda x: x != "")


def clean_text_for_wordpiece(text: Column) -> Column:
    """P11 (JVM part): drop NUL, U+FFFD and control/format characters other
    than tab/newline/CR, map whitespace to a space, surround CJK ideographs
    with spaces. Lower-casing and accent stripping happen per distinct word in
    the WordPiece function (they need Unicode normalization)."""
    t = F.regexp_replace(text, r"[\x{FFFD}\p{Cc}\p{Cf}&&[^\t\n\r]]", "")
    t = F.regexp_replace(t, r"[\t\n\r\p{Zs}&&[^ ]]", " ")  # a space stays as it is
    cjk = "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in CJK_RANGES)
    return F.regexp_replace(t, f"([{cjk}])", " $1 ")


def cleanup_tokenization(text: Column) -> Column:
    """Undo spaces that detokenized English gets before punctuation."""
    for a, b in CLEANUP_REPLACEMENTS:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text
