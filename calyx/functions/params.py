"""Parsing of ``passback_params``: a Python dict literal stored as text.

The text is turned into JSON by rewriting the bare Python tokens ``None``,
``True`` and ``False`` that are outside quoted strings, then parsed by
``from_json`` with single quotes and backslash escapes allowed.  Everything
runs as JVM expressions (regexp_replace + from_json), no Python per row.

Each rewrite uses one ``\\G``-anchored regex: the prefix group consumes, in
order, any characters that cannot start the token and whole quoted strings
(so ``'a: None, b'`` inside quotes is left alone), then the bare token is
replaced.  Possessive quantifiers keep the match linear.

Text that still is not JSON (truncated text, tuples, sets, bytes) is a
corrupt record: the strict parser fails the query, the lenient parser
returns an empty dict.  NULL and '' are an empty dict in both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys picked from the dict.
LTI_KEYS = ("oauth_consumer_key", "lis_result_sourcedid", "lis_outcome_service_url")
LESSON_KEYS = ("lesson_id", "lesson_name", "score")

_QUOTED = r"""'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+\""""


def _token_pattern(token: str) -> str:
    head, rest = token[0], token[1:]
    return (r"\G((?:[^'\"" + head + r"]|" + head + r"(?!" + rest + r"\b)|" + _QUOTED + r")*+)"
            + r"(?<![A-Za-z0-9_])" + token + r"\b")


_REWRITES = (("None", "null"), ("True", "true"), ("False", "false"))

PARAMS_JSON_OPTIONS = {
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "allowNonNumericNumbers": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt",
}


# \xNN escapes (Python's repr of control characters) -> JSON \u00NN, only
# where the backslash is not itself escaped (an even run of backslashes before it).
_HEX_ESCAPE = r"(?<!\\)((?:\\\\)*)\\x([0-9A-Fa-f]{2})"


def dict_literal_to_json(text: Column) -> Column:
    r"""Rewrite a Python dict literal into JSON text: the literals None / True /
    False outside strings become JSON tokens, ``\xNN`` escapes become ``\u00NN``."""
    out = F.regexp_replace(text, _HEX_ESCAPE, "$1\\\\u00$2")
    for py, js in _REWRITES:
        out = F.regexp_replace(out, _token_pattern(py), "$1" + js)
    return out


def with_json_text(df, text_col: str, out: str):
    """``dict_literal_to_json`` as column ``out``, NULL for blank text.

    Each rewrite is a projection of its own that runs its pattern only on
    texts that hold the token at all; most hold one or two of the four.
    """
    text = F.col(text_col)
    blank = text.isNull() | (F.trim(text) == "")
    passes = [("\\x", _HEX_ESCAPE, "$1\\\\u00$2")]
    passes += [(py, _token_pattern(py), "$1" + js) for py, js in _REWRITES]
    step = df.withColumn(out, F.when(~blank, text))
    for mark, pattern, to in passes:
        step = step.withColumn(out, F.when(F.col(out).contains(mark), F.regexp_replace(out, pattern, to))
                               .otherwise(F.col(out)))
    return step


def params_schema(keys=LTI_KEYS + LESSON_KEYS + ("graded",)) -> T.StructType:
    """All picked keys as strings (numbers and booleans keep their JSON text)."""
    return T.StructType([T.StructField(k, T.StringType()) for k in keys]
                        + [T.StructField("_corrupt", T.StringType())])


def parse_params(text: Column, keys=LTI_KEYS + LESSON_KEYS + ("graded",),
                 strict: bool = True) -> Column:
    """P3a (strict) / P3b (lenient): dict-literal text -> STRUCT of the picked keys.

    Strict raises on a corrupt record, lenient maps it to all-NULL fields.
    """
    keys = tuple(keys)
    schema = params_schema(keys)
    blank = text.isNull() | (F.trim(text) == "")
    js = dict_literal_to_json(text)
    parsed = F.from_json(js, schema, PARAMS_JSON_OPTIONS)
    bad = (~blank) & (parsed.isNull() | parsed["_corrupt"].isNotNull())
    empty = F.struct(*[F.lit(None).cast("string").alias(k) for k in keys])
    good = F.struct(*[parsed[k].alias(k) for k in keys])
    if strict:
        fail = F.raise_error(F.concat(F.lit("corrupt passback_params: "), text)).cast("string")
        return (F.when(blank, empty)
                 .when(bad, F.struct(*[fail.alias(k) for k in keys]))
                 .otherwise(good))
    return F.when(blank | bad, empty).otherwise(good)


def has_key(text: Column, key: str) -> Column:
    """True when the dict literal has ``key`` at its top level (even with a None value)."""
    return F.array_contains(F.json_object_keys(dict_literal_to_json(text)), key)


def py_bool(s: Column) -> Column:
    """JSON text of a Python bool/None -> BOOLEAN."""
    return F.when(s == "true", True).when(s == "false", False)


def with_parsed_params(df, text_col: str = "passback_params", out: str = "_params",
                       keys=LTI_KEYS + LESSON_KEYS + ("graded",), strict: bool = True,
                       json_col: str | None = "_params_json"):
    """Add the parsed dict as STRUCT column ``out`` (P3a strict / P3b lenient).

    Unlike ``parse_params`` (a single Column, fine when used once), this
    evaluates the rewrite and ``from_json`` once per row however many
    fields are read afterwards: each step is its own projection, and
    Catalyst does not merge a projection whose expensive expression the next
    one references several times.  ``json_col`` keeps the JSON text (for
    key-presence tests); pass None to drop it.
    """
    keys = tuple(keys)
    text = F.col(text_col)
    js = json_col or "_params_json"
    step = with_json_text(df, text_col, js)
    step = step.withColumn("_params_raw", F.from_json(F.col(js), params_schema(keys),
                                                      PARAMS_JSON_OPTIONS))
    raw = F.col("_params_raw")
    bad = F.col(js).isNotNull() & (raw.isNull() | raw["_corrupt"].isNotNull())
    empty = F.struct(*[F.lit(None).cast("string").alias(k) for k in keys])
    good = F.struct(*[raw[k].alias(k) for k in keys])
    if strict:
        fail = F.raise_error(F.concat(F.lit("corrupt passback_params: "), text)).cast("string")
        val = (F.when(F.col(js).isNull(), empty)
                .when(bad, F.struct(*[fail.alias(k) for k in keys])).otherwise(good))
    else:
        val = F.when(F.col(js).isNull() | bad, empty).otherwise(good)
    step = step.withColumn(out, val).drop("_params_raw")
    return step if json_col else step.drop(js)


def has_key_json(json_text, key: str):
    """Key presence on the already rewritten JSON text (see ``with_parsed_params``)."""
    return F.array_contains(F.json_object_keys(json_text), key)
