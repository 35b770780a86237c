"""Reading dynamically typed (variant) values as Spark columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Java's String.trim strips every character up to and including U+0020.
_BLANKS = "".join(chr(c) for c in range(0x21))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_number(json: Column) -> Column:
    return json.substr(1, 1).rlike("[-0-9]")


def _is_text(json: Column) -> Column:
    return json.startswith('"')


def _checked(result: Column, value: Column, target: str, strict: bool) -> Column:
    if not strict:
        return result
    problem = F.concat(F.lit(f"cannot read as {target}: "), F.coalesce(_as_text(value), F.lit("unset")))
    return let(result, lambda r: F.when(r.isNull(), F.raise_error(problem)).otherwise(r))


# The first character of a value's JSON text tells its kind.

def value_to_string(value: Column) -> Column:
    """Text of a value: text is trimmed, numbers print as doubles, null as ``null``, unset as empty."""
    return let(F.to_json(value), lambda j: (
        F.when(j.isNull(), F.lit(""))
        .when(_is_text(j), F.btrim(_as_text(value), F.lit(_BLANKS)))
        .when(_is_number(j), j.try_cast("double").cast("string"))
        .otherwise(j)
    ))


def value_to_double(value: Column, strict: bool = False) -> Column:
    """A number, or text that reads as one; otherwise null, or an error when ``strict``."""
    result = let(F.to_json(value), lambda j: (
        F.when(_is_number(j), j.try_cast("double")).when(_is_text(j), _as_text(value).try_cast("double"))
    ))
    return _checked(result, value, "double", strict)


def value_to_long(value: Column, strict: bool = False) -> Column:
    """A number rounded half up, or integer text; otherwise null, or an error when ``strict``."""
    rounded = lambda j: F.floor(j.try_cast("double") + F.lit(0.5)).cast("long")
    whole = lambda t: F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("long"))
    result = let(F.to_json(value), lambda j: (
        F.when(_is_number(j), F.coalesce(whole(j), rounded(j))).when(_is_text(j), let(_as_text(value), whole))
    ))
    return _checked(result, value, "long", strict)


def value_to_boolean(value: Column, strict: bool = False) -> Column:
    """A boolean; a number equal to 1; text equal to ``true`` in any case."""
    result = let(F.to_json(value), lambda j: (
        F.when(j.isin("true", "false"), j == "true")
        .when(_is_number(j), j.try_cast("double") == F.lit(1.0))
        .when(_is_text(j), F.lower(_as_text(value)) == "true")
    ))
    return _checked(result, value, "boolean", strict)


def _field(name: str) -> str:
    if "'" in name:
        raise ValueError(f"path component may not hold a quote: {name!r}")
    return f"$['{name}']"


def _fields(values: Column, name: str) -> Column:
    path = _field(name)
    return F.transform(values, lambda v: F.try_variant_get(v, path, "variant"))


def _spread(values: Column) -> Column:
    """Replace every list among ``values`` by its elements."""
    items = F.transform(
        values,
        lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v)),
    )
    return F.flatten(items)


def _list_depth(json: Column) -> Column:
    """How deep brackets nest in JSON text; text literals do not count."""
    bare = F.regexp_replace(json, r'"(?:[^"\\]++|\\.)*+"', "")
    marks = F.regexp_extract_all(bare, F.lit(r"[\[\]]"), F.lit(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    step = lambda a, m: let(a["now"] + F.when(m == "[", 1).otherwise(-1), lambda n: F.struct(
        n.alias("now"), F.greatest(a["most"], n).alias("most")))
    return F.when(json.contains("["), F.aggregate(marks, start, step, lambda a: a["most"])).otherwise(0)


def struct_strings(value: Column, path: Sequence[str]) -> Column:
    """Texts found at ``path``, fanning out over lists met on the way.

    A missing path gives an empty array, null leaves are skipped and a list leaf is
    flattened once. Lists nested directly in lists are followed as deep as the value nests.
    """
    if not path:
        raise ValueError("path is empty")

    def found(rounds: Column) -> Column:
        current = F.array(value)
        for level, name in enumerate(path):
            if level:
                current = F.aggregate(rounds, current, lambda items, _: _spread(items))
            current = F.filter(_fields(current, name), lambda v: v.isNotNull())
        leaves = F.filter(_spread(current), lambda v: ~F.is_variant_null(v))
        return F.transform(leaves, value_to_string)

    rounds = let(_list_depth(F.to_json(value)), lambda d: F.when(d > 0, F.sequence(F.lit(1), d)).otherwise(F.array().cast("array<int>")))
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(let(rounds, found) if len(path) > 1 else found(rounds))


def struct_delimited(value: Column, path: str, delimiter: str) -> Column:
    """The texts at a dotted path joined by ``delimiter``."""
    if not path or not path.strip():
        raise ValueError("path is blank")
    if not delimiter or not delimiter.strip():
        raise ValueError("delimiter is blank")
    return F.array_join(struct_strings(value, path.split(".")), delimiter)


def json_attribute(payload: Column, path: Sequence[str]) -> Column:
    """Attribute of a JSON payload: text raw, scalars as text, containers as JSON text."""
    return F.get_json_object(payload, "$" + "".join(f"['{p}']" for p in path))


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text)
