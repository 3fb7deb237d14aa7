"""Conversation data → training text and ids.

Turns are always ordered by ``turn`` (``array_sort`` of collected structs),
never by input order. A conversation is one group; its rendered text is one
output value, so the group is bounded by what a single row can hold.
"""

from __future__ import annotations

import ast
import json

import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.text import PY_WS

# Fixed values of the chat formats.
CHATML_DEFAULT_SYSTEM = "You are a helpful assistant."
CHATML_START = "<|im_start|>"
CHATML_END = "<|im_end|>"
GLM_PREFIX = "[gMASK]sop"
GLM_ROLES = ["system", "user", "assistant", "observation"]
GLM_SPECIAL_TOKENS = ["[MASK]", "[gMASK]", "[sMASK]", "sop", "eop",
                      "<|system|>", "<|user|>", "<|assistant|>", "<|observation|>"]
ASSISTANT_TAG = "<|assistant|>"
# Placeholder the GLM response parser rewrites in the returned text only.
TRAINING_TIME_PLACEHOLDER = "[[训练时间]]"
TRAINING_TIME_VALUE = "2023年"


def collect_turns(convs: DataFrame, conv_col: str = "conv_id", extra: list[str] = ()) -> DataFrame:
    """``(conv_id, msgs array<struct<turn, role, text, ...>>)`` ordered by turn."""
    fields = ["turn", "role", "text", *extra]
    return convs.groupBy(conv_col).agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("msgs"))


def render_chatml(msgs: Column, add_generation_prompt: bool = False) -> Column:
    """ChatML with a default system turn when the first role is not
    ``system``."""
    default = F.when(msgs[0]["role"] != "system",
                     F.lit(f"{CHATML_START}system\n{CHATML_DEFAULT_SYSTEM}{CHATML_END}\n")).otherwise("")
    body = F.array_join(F.transform(msgs, lambda m: F.concat(
        F.lit(CHATML_START), m["role"], F.lit("\n"), m["text"], F.lit(CHATML_END + "\n"))), "")
    tail = F.lit(f"{CHATML_START}assistant\n" if add_generation_prompt else "")
    return F.when(F.size(msgs) == 0, tail).otherwise(F.concat(default, body, tail))


def render_glm(msgs: Column, add_generation_prompt: bool = False) -> Column:
    """``[gMASK]sop`` before the first turn, each turn
    ``<|role|> \\n text``, optional ``<|assistant|>``."""
    body = F.array_join(F.transform(msgs, lambda m: F.concat(
        F.lit("<|"), m["role"], F.lit("|> \n "), m["text"])), "")
    tail = F.lit(ASSISTANT_TAG if add_generation_prompt else "")
    return F.when(F.size(msgs) == 0, tail).otherwise(F.concat(F.lit(GLM_PREFIX), body, tail))


def glm_special_ids(base: int) -> dict[str, int]:
    """Ids of the GLM special tokens when they follow a ``base``-sized vocabulary."""
    return {t: base + i for i, t in enumerate(GLM_SPECIAL_TOKENS)}


def glm_turn_ids(role: Column, meta_ids: Column, text_ids: Column, special: dict[str, int]) -> Column:
    """``[<|role|>] + ids(metadata + "\\n") + ids(content)``; roles outside
    the four GLM roles raise."""
    role_id = F.lit(None).cast("int")
    for r in GLM_ROLES:
        role_id = F.when(role == r, F.lit(special[f"<|{r}|>"])).otherwise(role_id)
    role_id = F.when(role_id.isNull(), F.raise_error(F.concat(F.lit("unknown role: "), role))).otherwise(role_id)
    return F.concat(F.array(role_id.cast("int")), meta_ids, text_ids)


def glm_system_content(role: Column, content: Column, tools_json: Column) -> Column:
    """A system turn that carries tools gets them appended as JSON with
    four-space indentation (non-ASCII kept). The JSON re-indentation is a
    small per-row Arrow helper; other turns are unchanged (no Python)."""

    @F.arrow_udf("string")
    def indent(js: pa.Array) -> pa.Array:
        import json
        return pa.array([None if v is None else json.dumps(json.loads(v), indent=4, ensure_ascii=False)
                         for v in js.to_pylist()], pa.string())

    has = (role == "system") & tools_json.isNotNull()
    return F.when(has, F.concat(content, F.lit("\n"), indent(tools_json))).otherwise(content)


def conversation_ids(turn_ids: DataFrame, conv_col: str = "conv_id", ids_col: str = "ids",
                     suffix: list[int] | None = None, prefix: list[int] | None = None,
                     max_len: int | None = None) -> DataFrame:
    """Per conversation, the turns' ids in turn order, each followed by
    ``suffix`` (RWKV: the eos id), the whole preceded by ``prefix`` (GLM: the
    ``[gMASK] sop`` ids) and, when ``max_len`` is given, cut to its last
    ``max_len`` ids (O5)."""
    per_turn = F.col(ids_col)
    if suffix:
        per_turn = F.concat(per_turn, F.array(*[F.lit(x) for x in suffix]))
    g = turn_ids.groupBy(conv_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col("turn"), per_turn.alias("ids")))).alias("_t"))
    ids = F.flatten(F.transform("_t", lambda s: s["ids"]))
    if prefix:
        ids = F.concat(F.array(*[F.lit(x) for x in prefix]), ids)
    if max_len is not None:
        ids = keep_last(ids, max_len)
    return g.select(conv_col, ids.alias("input_ids"))


def keep_last(ids: Column, n: int) -> Column:
    """The last ``n`` ids (``slice`` with a negative start needs the guard)."""
    return F.when(F.size(ids) > n, F.slice(ids, -n, n)).otherwise(ids)


def left_pad_batches(df: DataFrame, ids_col: str, batch_col: str, pad_id: int = 0,
                     multiple: int | None = None) -> DataFrame:
    """Left-pad every row to the longest row of its batch (optionally
    rounded up to a multiple), with attention mask and position ids.
    Batches are bounded groups (``batch_col`` is e.g. ``row_id div B``)."""
    m = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    if multiple:
        m = F.ceil(m / multiple) * multiple
    df = df.withColumn("_max", m.cast("int"))
    n_pad = F.col("_max") - F.size(ids_col)
    return df.select(
        *[c for c in df.columns if c not in (ids_col, "_max")],
        F.concat(F.array_repeat(F.lit(pad_id), n_pad), F.col(ids_col)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(0), n_pad), F.array_repeat(F.lit(1), F.size(ids_col))).alias("attention_mask"),
        F.concat(F.array_repeat(F.lit(0), n_pad),
                 F.when(F.size(ids_col) > 0, F.sequence(F.lit(0), F.size(ids_col) - 1))
                 .otherwise(F.array().cast("array<int>"))).alias("position_ids"),
    )


def build_pair(a: Column, b: Column | None, prefix: list[int] = (), sep: list[int] = (),
               suffix: list[int] = ()) -> Column:
    """``prefix + a (+ sep + b + suffix)`` as an array expression; GLM uses
    prefix = [gMASK, sop] and suffix = [eos], RWKV uses sep = [bos] when set."""
    def arr(xs):
        return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<int>")
    out = F.concat(arr(prefix), a)
    if b is not None:
        out = F.concat(out, arr(sep), b, arr(suffix))
    return out


def special_tokens_mask(a: Column, b: Column | None, n_prefix: int, n_sep: int = 0,
                        n_suffix: int = 0) -> Column:
    """1 for added special ids, 0 for sequence ids, aligned with ``build_pair``."""
    out = F.concat(F.array_repeat(F.lit(1), n_prefix), F.array_repeat(F.lit(0), F.size(a)))
    if b is not None:
        out = F.concat(out, F.array_repeat(F.lit(1), n_sep), F.array_repeat(F.lit(0), F.size(b)),
                       F.array_repeat(F.lit(1), n_suffix))
    return out


def parse_response(df: DataFrame, output_col: str = "output", keep: list[str] = ()) -> DataFrame:
    """Split generated text at ``<|assistant|>``; per piece, the first
    line is metadata and the rest content (no newline: metadata is empty);
    blank metadata → stripped content. A tool call's arguments are read by
    ``parse_tool_calls``; nothing is evaluated."""
    pieces = df.select(*keep, F.posexplode(F.split(F.col(output_col), r"<\|assistant\|>", -1))
                       .alias("pos", "response"))
    nl = F.instr("response", "\n")
    meta = F.when(nl > 0, F.expr("substring(response, 1, instr(response, '\n') - 1)")).otherwise(F.lit(""))
    content = F.when(nl > 0, F.expr("substring(response, instr(response, '\n') + 1)")).otherwise(F.col("response"))
    py_strip = f"^{PY_WS}+|{PY_WS}+$"
    blank = F.length(F.regexp_replace(meta, py_strip, "")) == 0
    content = F.when(blank, F.regexp_replace(content, py_strip, "")).otherwise(content)
    # the text handed back to the caller (history keeps the raw content)
    returned = F.when(blank, F.replace(content, F.lit(TRAINING_TIME_PLACEHOLDER), F.lit(TRAINING_TIME_VALUE)))
    return pieces.select(*keep, "pos", meta.alias("metadata"), content.alias("content"),
                         returned.alias("returned"))


def call_arguments(source: str | None) -> tuple[dict[str, str] | None, str | None]:
    """``(arguments, error)`` of one ``tool_call(name=literal, ...)``: values as JSON
    text. The source is parsed, never run: a value may be a string, number,
    boolean, None, or a list, tuple or dict of those, signs and joined strings
    included; anything else is an error."""
    try:
        call = ast.parse((source or "").strip(), mode="eval").body
    except (SyntaxError, ValueError, MemoryError, RecursionError):
        return None, "not_an_expression"
    if not isinstance(call, ast.Call) or not isinstance(call.func, ast.Name) or call.func.id != "tool_call":
        return None, "not_a_tool_call"
    if call.args or any(k.arg is None for k in call.keywords):
        return None, "not_only_keywords"
    out = {}
    for k in call.keywords:
        if k.arg in out:
            return None, "repeated_keyword"
        try:
            out[k.arg] = json.dumps(ast.literal_eval(k.value), ensure_ascii=False, allow_nan=False)
        except (ValueError, TypeError, RecursionError, MemoryError):
            return None, "not_a_literal"
    return out, None


def parse_tool_calls(df: DataFrame, metadata_col: str = "metadata", content_col: str = "content", keep: list[str] = ()) -> DataFrame:
    """Generated tool calls → ``name`` (the stripped metadata), ``parameters``
    (argument → JSON text of its value) and ``error``. The call is what lies
    between the first and the last line of the content (its code fence). A call
    that is not one, or whose arguments are not literals, has null parameters and
    its reason in ``error``, so that malformed output can be set aside."""
    @F.pandas_udf("parameters map<string,string>, error string")
    def read(sources: pd.Series) -> pd.DataFrame:
        got = [call_arguments(s) for s in sources]
        return pd.DataFrame({"parameters": [g[0] for g in got], "error": [g[1] for g in got]})
    lines = F.split(F.coalesce(content_col, F.lit("")), "\n", -1)
    inner = F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 2, F.lit(0))), "\n")
    name = F.regexp_replace(F.coalesce(metadata_col, F.lit("")), f"^{PY_WS}+|{PY_WS}+$", "")
    return df.select(*keep, name.alias("name"), read(inner).alias("_call")).select(*keep, "name", "_call.parameters", "_call.error")
