"""Prompt templates as Column -> Column functions.

A template is a string with `{name}` placeholders. Parameters are a
`MAP<STRING,STRING>`; chat history parameters a
`MAP<STRING, ARRAY<STRUCT<role,content>>>`. Everything is a built-in
higher-order expression, so it stays in the JVM and works the same on a
batch or a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the template format of the reference.
# Placeholder: a brace pair around letters, digits, '_', '[', ']' or '.'.
PLACEHOLDER = r"\{([a-zA-Z0-9_\[\].]+)\}"
# Escaped placeholder: both braces preceded by a backslash.
ESCAPED_PLACEHOLDER = r"\\\{([a-zA-Z0-9_\[\].]+)\\\}"
# The role that marks a chat-history slot in a message template.
CHAT_HISTORY_ROLE = "chat_history"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def template_vars(template) -> Column:
    """Distinct variable names in first-seen order (null for null)."""
    return F.array_distinct(F.regexp_extract_all(_col(template), F.lit(PLACEHOLDER), 1))


def missing_vars(template, params) -> Column:
    """T4: variables without a parameter. A key with a null value is present."""
    p = _col(params)
    return F.filter(template_vars(template),
                    lambda n: ~F.coalesce(F.map_contains_key(p, n), F.lit(False)))


def substitute(template, params) -> Column:
    """Replace each `{name}` by its parameter in one pass (no unescape)."""
    template, params = _col(template), _col(params)
    # Literal pieces between placeholders, and the names in between; one
    # pass, so values are never expanded again.
    pieces = F.split(template, PLACEHOLDER, -1)
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER), 1)
    merged = F.zip_with(
        pieces, names,
        lambda piece, name: F.concat(
            piece,
            F.when(name.isNull(), F.lit(""))
            .otherwise(F.coalesce(F.try_element_at(params, name), F.lit("null"))),
        ),
    )
    return F.array_join(merged, "")


def unescape(text) -> Column:
    """`\\{x\\}` becomes `{x}`."""
    return F.regexp_replace(_col(text), ESCAPED_PLACEHOLDER, "{$1}")


def format_template(template, params) -> Column:
    """T2 + T3: substitute every `{name}` in one pass, then unescape.

    A missing variable prints `null` here; callers find missing variables
    with `missing_vars` and route those rows to a quarantine output.
    """
    t = _col(template)
    p = _col(params)
    return unescape(substitute(t, p))


def merge_entries(entries: Column) -> Column:
    """Entries (key, value) to a map where a repeated key keeps its first
    position and takes its last value, as building an object does; never
    fails on duplicate keys."""
    firsts = F.filter(entries, lambda e, i: F.array_position(
        F.transform(entries, lambda x: x["key"]), e["key"]) == i + 1)
    return F.map_from_entries(F.transform(firsts, lambda e: F.struct(
        e["key"].alias("key"),
        F.element_at(F.filter(entries, lambda x: x["key"] == e["key"]), -1)["value"].alias("value"))))


def format_map(m, params) -> Column:
    """Format map keys as well as values (keys that become equal keep
    the first position and the last value)."""
    p = _col(params)
    entries = F.transform(F.map_entries(_col(m)), lambda e: F.struct(
        format_template(e["key"], p).alias("key"), format_template(e["value"], p).alias("value")))
    return merge_entries(entries)


def message_vars(messages) -> Column:
    """T5: variables of a message list, depth first, role before content.

    Deduplicated inside each string leaf only, as the reference does.
    """
    return F.flatten(F.transform(
        _col(messages),
        lambda m: F.concat(F.coalesce(template_vars(m["role"]), F.array().cast("array<string>")),
                           F.coalesce(template_vars(m["content"]), F.array().cast("array<string>"))),
    ))


def format_message(m: Column, params: Column) -> Column:
    return F.struct(format_template(m["role"], params).alias("role"),
                    format_template(m["content"], params).alias("content"))


def format_messages(messages, params) -> Column:
    """Format role and content of every message."""
    p = _col(params)
    return F.transform(_col(messages), lambda m: format_message(m, p))


def _leaf_vars(m: Column) -> Column:
    return F.concat(F.coalesce(template_vars(m["role"]), F.array().cast("array<string>")),
                    F.coalesce(template_vars(m["content"]), F.array().cast("array<string>")))


def splice_history(messages, params, history) -> Column:
    """Replace each `chat_history` item by the messages its variables name.

    Other items are formatted (T6); spliced messages are inserted as they are.
    """
    p = _col(params)
    h = _col(history)
    return F.flatten(F.transform(
        _col(messages),
        lambda m: F.when(
            m["role"] == F.lit(CHAT_HISTORY_ROLE),
            F.flatten(F.transform(
                _leaf_vars(m),
                lambda n: F.coalesce(F.try_element_at(h, n),
                                     F.array().cast("array<struct<role:string,content:string>>")),
            )),
        ).otherwise(F.array(format_message(m, p))),
    ))


def history_errors(messages, history) -> Column:
    """Problems with `chat_history` items, as text; empty when none.

    An item without a variable is an error; so is a variable whose history
    is missing or null. An empty list is a valid history.
    """
    h = _col(history)
    hist_items = F.filter(_col(messages), lambda m: m["role"] == F.lit(CHAT_HISTORY_ROLE))
    no_var = F.transform(
        F.filter(hist_items, lambda m: F.size(_leaf_vars(m)) == 0),
        lambda m: F.lit("chat_history item without a variable"),
    )
    missing = F.transform(
        F.filter(F.flatten(F.transform(hist_items, _leaf_vars)),
                 lambda n: F.try_element_at(h, n).isNull()),
        lambda n: F.concat(F.lit("no history for variable "), n),
    )
    return F.concat(no_var, missing)


def resolve_prompt_text(prompt, prompt_parts) -> Column:
    """T11 (untemplated part): a text prompt, else its parts joined with ''.
    Token-number parts are cast to text first; null stays null."""
    return F.coalesce(_col(prompt), F.array_join(_col(prompt_parts).cast("array<string>"), ""))


def nested_vars(c: Column, dt) -> Column:
    """T5 for any nested value: variables of every string leaf, depth first
    in schema order, deduplicated inside each leaf only; struct field names
    and map keys are not scanned; null, numbers and booleans give none."""
    from pyspark.sql import types as T
    empty = F.array().cast("array<string>")
    if isinstance(dt, T.StringType):
        return F.coalesce(template_vars(c), empty)
    if isinstance(dt, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(c, lambda x: nested_vars(x, dt.elementType))), empty)
    if isinstance(dt, T.MapType):
        return F.coalesce(F.flatten(F.transform(F.map_values(c), lambda x: nested_vars(x, dt.valueType))), empty)
    if isinstance(dt, T.StructType):
        parts = [nested_vars(c[f.name], f.dataType) for f in dt.fields]
        return F.concat(*parts) if parts else empty
    return empty


def format_nested(c: Column, dt, params) -> Column:
    """T6/T7 for any nested value: every string leaf formatted, map keys
    too; struct field names are fixed by the schema; other leaves pass
    through unchanged (as the reference means to)."""
    from pyspark.sql import types as T
    p = _col(params)
    if isinstance(dt, T.StringType):
        return format_template(c, p)
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: format_nested(x, dt.elementType, p))
    if isinstance(dt, T.MapType):
        if not isinstance(dt.keyType, T.StringType):
            return F.transform_values(c, lambda k, v: format_nested(v, dt.valueType, p))
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            format_template(e["key"], p).alias("key"), format_nested(e["value"], dt.valueType, p).alias("value")))
        return merge_entries(entries)
    if isinstance(dt, T.StructType):
        inner = F.struct(*[format_nested(c[f.name], f.dataType, p).alias(f.name) for f in dt.fields])
        return F.when(c.isNull(), F.lit(None).cast(dt)).otherwise(inner)
    return c
