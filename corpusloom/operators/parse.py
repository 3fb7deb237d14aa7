"""JSON line parsing and validation (P1-P4, P10, SN5), all in the JVM.

Strict parse without Python: ``a = try_parse_json('[' || value || ']')``
accepts a line whose first JSON value is followed by nothing, by ``,...`` (then
``a[1]`` exists and we reject) or by ``]...`` (trailing junk that the parser
stops before). The last case can only happen when the line contains ``]``,
so only those lines pay for the second wrapper
``b = try_parse_json('{"k":' || value || '}')``, which rejects any text after
the value that does not start with ``}`` or ``,``. No line passes both wrappers
unless it is exactly one JSON value.

Spark's variant values are limited in size, so a long line that the variant
parser refuses takes a second JVM route, ``from_json`` with the same two
wrappers; no line is rejected for its length.

Rejected lines get a reason: ``bad_utf8``, ``bad_json``, ``not_object`` or
``bad_type`` (a key value that is neither a string, a list of strings, null
nor missing).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Refused lines above this many bytes are read again (shorter ones are no JSON).
LONG_LINE = 8 << 20
# from_json as strict as the variant parser, for strings of any length.
_STRICT = "map('maxStringLen', '2147483647', 'allowNonNumericNumbers', 'false', 'allowSingleQuotes', 'false')"
REASONS = ("bad_json", "not_object", "bad_type", "bad_utf8")


def json_path(key: str) -> str:
    """Literal top-level key as a variant path (a dot has no path meaning)."""
    if '"' not in key:
        return '$["' + key.replace("\\", "\\\\") + '"]'
    if "'" not in key:
        return "$['" + key + "']"
    raise ValueError(f"JSON key with both quote characters is not supported: {key!r}")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _parsed(value: str = "value") -> tuple[Column, Column]:
    a = F.expr(f"try_parse_json(concat('[', {value}, ']'))")
    strict = F.when(F.instr(F.col(value), "]") == 0, F.lit(True)).otherwise(
        F.expr(f"try_parse_json(concat('{{\"k\":', {value}, '}}'))").isNotNull())
    return a, strict


def _key_value(rec: str, key: str) -> Column:
    return F.expr(f"try_variant_get({rec}, {_sql_str(json_path(key))}, 'variant')")


def key_type(rec: str, key: str) -> Column:
    return F.expr(f"schema_of_variant(try_variant_get({rec}, {_sql_str(json_path(key))}, 'variant'))")


def _key_sentences(rec: str, key: str, kind: Column) -> Column:
    path = _sql_str(json_path(key))
    return (F.when(kind == "STRING", F.array(F.expr(f"try_variant_get({rec}, {path}, 'string')")))
            .when(kind.startswith("ARRAY"), F.expr(f"try_variant_get({rec}, {path}, 'array<string>')"))
            # missing key or JSON null: the empty string (Q6/Q7)
            .otherwise(F.array(F.lit(""))))


def _key_ok(kind: Column, sents: Column) -> Column:
    good_kind = kind.isNull() | kind.isin("VOID", "STRING", "ARRAY<STRING>", "ARRAY<VOID>")
    no_null_items = ~F.coalesce(F.exists(sents, lambda x: x.isNull()), F.lit(False))
    return good_kind & no_null_items


def _long_route(value: str, keys: list[str]) -> tuple[Column, dict[str, tuple[Column, Column]]]:
    """For long lines: the reason (NULL: accepted) and per key ``(sentences,
    type is allowed)``. A key's raw text tells its type: only a list equals the
    JSON form of its items read as strings when all of them are strings."""
    def read(schema: str, text: str) -> str:
        return f"from_json({text}, {_sql_str(schema)}, {_STRICT})"
    whole, wrapped = f"concat('[', {value}, ']')", "concat('{\"k\":', " + value + ", '}')"
    one = F.expr(f"size({read('array<string>', whole)}) = 1 AND {read('map<string,string>', wrapped)} IS NOT NULL")
    is_object = F.expr(f"ltrim(' \\t', {value}) LIKE '{{%'")
    fields, ok = {}, F.lit(True)
    for k in keys:
        name = "`" + k.replace("`", "``") + "`"
        get = lambda kind, name=name, k=k: F.expr(f"get({read(f'array<struct<{name}:{kind}>>', whole)}, 0)").getField(k)
        raw, items = get("string"), get("array<string>")
        other = get("double").isNotNull() | get("boolean").isNotNull() | get("map<string,string>").isNotNull()
        strings_only = (F.to_json(items) == raw) & ~F.exists(items, lambda x: x.isNull())
        sentences = F.when(items.isNotNull(), items).otherwise(F.array(F.coalesce(raw, F.lit(""))))
        allowed = F.when(items.isNotNull(), strings_only).otherwise(~other)
        fields[k] = sentences, allowed
        ok = ok & allowed
    reason = (F.when(~F.coalesce(one, F.lit(False)), F.lit("bad_json")).when(~is_object, F.lit("not_object"))
              .when(~ok, F.lit("bad_type")))
    return reason, fields


def classify(lines: DataFrame, keys=("text",), value: str = "value") -> DataFrame:
    """All input columns plus ``reason`` (NULL when accepted) and, for every
    key, an ``ARRAY<STRING>`` column named after the key: a string becomes a
    one-element list, a list stays, null and missing become ``[""]``."""
    keys = list(keys)
    a, strict = _parsed(value)
    df = lines.select("*", a.alias("_a"), strict.alias("_strict"))
    df = df.select(
        "*",
        F.expr("try_variant_get(_a, '$[0]', 'variant')").alias("_rec"),
        F.expr("try_variant_get(_a, '$[1]', 'variant')").isNotNull().alias("_has1"),
    )
    kinds = {k: key_type("_rec", k) for k in keys}
    df = df.select("*", *[kinds[k].alias(f"_kind{i}") for i, k in enumerate(keys)])
    sents = {k: _key_sentences("_rec", k, F.col(f"_kind{i}")) for i, k in enumerate(keys)}
    df = df.select("*", *[sents[k].alias(f"_s{i}") for i, k in enumerate(keys)])
    type_ok = F.lit(True)
    for i, k in enumerate(keys):
        type_ok = type_ok & _key_ok(F.col(f"_kind{i}"), F.col(f"_s{i}"))
    reason = (F.when(~F.expr(f"is_valid_utf8({value})"), F.lit("bad_utf8"))
              .when(F.col("_a").isNull() | F.col("_rec").isNull() | F.col("_has1") | ~F.col("_strict"),
                    F.lit("bad_json"))
              .when(~F.expr("schema_of_variant(_rec)").startswith("OBJECT"), F.lit("not_object"))
              .when(~type_ok, F.lit("bad_type")))
    is_long = F.col("_a").isNull() & (F.octet_length(value) > LONG_LINE) & F.expr(f"is_valid_utf8({value})")
    long_reason, long_keys = _long_route(value, keys)
    return df.select(*lines.columns, F.when(is_long, long_reason).otherwise(reason).alias("reason"),
                     *[F.when(is_long, long_keys[k][0]).otherwise(F.col(f"_s{i}")).alias(k) for i, k in enumerate(keys)])


def records(classified: DataFrame, keys=("text",), id_col: str = "line_id") -> DataFrame:
    """Accepted lines in long form ``(id, key, sentences)`` (P4 fan-out)."""
    keys = list(keys)
    ok = classified.where(F.col("reason").isNull())
    if len(keys) == 1:
        return ok.select(id_col, F.lit(keys[0]).alias("key"), F.col(keys[0]).alias("sentences"))
    stack = "stack({n}, {items}) as (key, sentences)".format(
        n=len(keys), items=", ".join(f"{_sql_str(k)}, `{k}`" for k in keys))
    return ok.select(id_col, F.expr(stack))


def quarantine(classified: DataFrame) -> DataFrame:
    """SN5: rejected lines with their reason."""
    return (classified.where(F.col("reason").isNotNull())
            .select("file_path", "line_no", "line_id", "reason", "value"))


def first_bad_line(classified: DataFrame) -> DataFrame:
    """The first rejected line of the corpus (or no row)."""
    return quarantine(classified).orderBy("line_id").limit(1)


def parse_stats(classified: DataFrame, name: str = "parse_stats") -> DataFrame:
    """A5: attach running counters (lines, accepted, chars, bytes) to a plan via
    ``observe``; the values are read from the ``Observation`` after an action."""
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("reason").isNull(), 1)).alias("accepted"),
        F.sum(F.length("value")).alias("chars"),
        F.sum(F.octet_length("value")).alias("bytes"),
    )


def interval_stats(classified: DataFrame, every: int = 100_000) -> DataFrame:
    """A5: lines, accepted lines, characters and bytes of every run of ``every``
    lines of the corpus (a partial aggregation; what a progress report prints)."""
    return (classified.groupBy(F.expr(f"line_id div {int(every)}").alias("interval"))
            .agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("accepted"),
                 F.sum(F.length("value")).alias("chars"), F.sum(F.octet_length("value")).alias("bytes")))
