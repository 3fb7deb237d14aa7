"""Arguments of generated tool calls are parsed, never run."""

import json

import pytest

from corpusloom.operators.chat import call_arguments, parse_tool_calls


@pytest.mark.parametrize("source,want", [
    ("tool_call()", {}), (" tool_call(a=1, b='x') ", {"a": "1", "b": '"x"'}),
    ("""tool_call(q="it's", r='say "hi"', s='a\\'b\\n')""", {"q": json.dumps("it's"), "r": json.dumps('say "hi"'), "s": json.dumps("a'b\n")}),
    ("tool_call(a=[1, -2.5, {'k': (True, None)}], b='x' 'y')", {"a": '[1, -2.5, {"k": [true, null]}]', "b": '"xy"'}),
    ("tool_call(été='ü')", {"été": '"ü"'}),
])
def test_literals(source, want):
    assert call_arguments(source) == (want, None)


@pytest.mark.parametrize("source,error", [
    (None, "not_an_expression"), ("", "not_an_expression"), ("tool_call(a='x)", "not_an_expression"), ("tool_call(a=1", "not_an_expression"),
    ("tool_call(a=1); x", "not_an_expression"), ("x = 1", "not_an_expression"), ("a" * 10 + "(", "not_an_expression"), ("1 + 1", "not_a_tool_call"),
    ("other(a=1)", "not_a_tool_call"), ("m.tool_call(a=1)", "not_a_tool_call"), ("tool_call(1)", "not_only_keywords"),
    ("tool_call(**{'a': 1})", "not_only_keywords"), ("tool_call(a=open('x'))", "not_a_literal"), ("tool_call(a=b)", "not_a_literal"),
    ("tool_call(a=1e999)", "not_a_literal"), ("tool_call(a=b'x')", "not_a_literal"), ("tool_call(a={1, 2})", "not_a_literal"),
    ("(" * 5000, "not_an_expression"),
])
def test_what_is_not_a_literal_call(source, error):
    assert call_arguments(source) == (None, error)


def test_rows(spark):
    rows = [(1, " search ", "```python\ntool_call(q='a\\nb',\n  n=2)\n```"), (2, "search", "tool_call(q=1)"), (3, None, None), (4, "x", "```\n```"),
            (5, "go", "```\ntool_call(q=__import__('os'))\n```")]
    got = {x.id: x for x in parse_tool_calls(spark.createDataFrame(rows, "id int, metadata string, content string"), keep=["id"]).collect()}
    assert got[1].name == "search" and got[1].parameters == {"q": '"a\\nb"', "n": "2"} and got[1].error is None
    assert [got[k].error for k in (2, 3, 4, 5)] == ["not_an_expression"] * 3 + ["not_a_literal"]
    assert got[3].name == "" and got[5].parameters is None
