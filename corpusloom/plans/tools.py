"""Registered query of tool-call parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import chat
from corpusloom.plans.fixtures import table


def q_tool_calls(spark, sf_dir):
    """Every turn as a generated tool call with its text as a quoted argument
    (quotes, backslashes and line ends escaped) beside nested literals; in each
    fifth turn the closing quote is lost."""
    conv = table(spark, sf_dir, "conversations")
    quoted = F.col("text")
    for a, b in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r")):
        quoted = F.replace(quoted, F.lit(a), F.lit(b))
    end = F.when(F.pmod("turn", F.lit(5)) == 4, "").otherwise("'")
    call = F.concat(F.lit("```python\ntool_call(n="), F.col("turn").cast("string"), F.lit(', nested=["it\'s", {\'a\': (1, None)}], text=\''), quoted, end,
                    F.lit(")\n```"))
    made = conv.select("conv_id", "turn", F.concat(F.lit(" "), F.col("role"), F.lit(" ")).alias("metadata"), call.alias("content"))
    got = chat.parse_tool_calls(made, keep=["conv_id", "turn"])
    back = F.from_json(F.concat(F.lit("["), F.col("parameters")["text"], F.lit("]")), "array<string>")[0]
    return got.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "name",
                      F.coalesce(back, F.lit("-")).alias("text"), F.coalesce(F.col("parameters")["n"].cast("long"), F.lit(-1)).alias("n"),
                      F.coalesce(F.col("parameters")["nested"], F.lit("-")).alias("nested"), F.coalesce("error", F.lit("-")).alias("error"))


SQL_TOOL_CALLS = """
SELECT conv_id, turn, role AS name, CASE WHEN turn % 5 <> 4 THEN text ELSE '-' END AS text,
       CASE WHEN turn % 5 <> 4 THEN turn ELSE -1 END::BIGINT AS n,
       CASE WHEN turn % 5 <> 4 THEN '["it''s", {"a": [1, null]}]' ELSE '-' END AS nested,
       CASE WHEN turn % 5 = 4 THEN 'not_an_expression' ELSE '-' END AS error
FROM conversations
"""

QUERIES = {"tool_calls": (q_tool_calls, SQL_TOOL_CALLS)}
