"""Contracts from their documents: a JSON Schema becomes quality rules over JSON lines.

A line is parsed once, to a variant; every rule is a column over it, so
``quality.report``, ``quality.violations`` and ``quality.obeys`` take them as they are.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake import schemas
from plantlake.operators.quality import Rule

#: Keywords that say nothing about validity.
ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}

FORMATS = {
    "uuid": lambda text: text.rlike("(?i)" + schemas.UUID_PATTERN),
    "date": lambda text: text.rlike(f"^{schemas.ISO_DATE}$") & text.try_cast("date").isNotNull(),
    "date-time": lambda text: text.rlike(f"^{schemas.ISO_DATE}{schemas.ISO_CLOCK}$")
    & F.try_to_timestamp(text).isNotNull(),
}


def load(spark: SparkSession, path: str) -> dict:
    """A contract document, from wherever Spark can read."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def documents(messages: DataFrame) -> DataFrame:
    """The lines with ``doc``, their JSON as a variant; null for a line that is none."""
    return messages.withColumn("doc", F.try_parse_json(F.col("value").cast("string")))


def compiled(schema: dict) -> list[Rule]:
    """Rules for :func:`documents` rows.

    ``valid:PATH`` judges a value where it is present by all its keywords,
    ``required:PATH`` a key of an object; ``[]`` in a path stands for all items of an
    array. A JSON null is present. Keywords, types and formats that are not
    understood raise a ValueError, so no part of a contract is passed over.
    """
    return _rules(schema, F.col("doc"), "")


def _rules(schema: dict, node: Column, path: str) -> list[Rule]:
    unknown = set(schema) - ANNOTATIONS - set(_KEYWORDS) - {"properties", "items", "required"}
    if unknown:
        raise ValueError(f"{path or '$'}: cannot judge by {sorted(unknown)}")
    root = not path
    checks = [_KEYWORDS[k](schema[k], node) for k in schema if k in _KEYWORDS]
    rules = [Rule(f"valid:{path or '$'}", reduce(and_, checks), None if root else node.isNotNull())] if checks else []
    for key in schema.get("required", []):
        # a line that is no document lacks every key
        within = None if root else _kind(node).startswith("OBJECT")
        rules.append(Rule(f"required:{_under(path, key)}", _child(node, key).isNotNull(), within))
    for key, sub in schema.get("properties", {}).items():
        rules += _rules(sub, _child(node, key), _under(path, key))
    return rules + _item_rules(schema, node, path)


def _item_rules(schema: dict, node: Column, path: str) -> list[Rule]:
    """Each rule of the items, for all of them together."""
    if "items" not in schema:
        return []
    items, sub, below = F.try_variant_get(node, "$", "array<variant>"), schema["items"], f"{path}[]"
    names = [rule.name for rule in _rules(sub, F.lit(None).cast("variant"), below)]

    def all_keep(i: int) -> Column:
        return F.forall(items, lambda item: ~_rules(sub, item, below)[i].broken())

    return [Rule(name, all_keep(i), _kind(node).startswith("ARRAY")) for i, name in enumerate(names)]


def _under(path: str, key: str) -> str:
    return f"{path}.{key}" if path else key


def _child(node: Column, key: str) -> Column:
    if '"' in key or "\\" in key:
        raise ValueError(f"cannot address the key {key!r}")
    return F.try_variant_get(node, f'$["{key}"]', "variant")


def _kind(node: Column) -> Column:
    return F.schema_of_variant(node)


def _text(node: Column) -> Column:
    return F.try_variant_get(node, "$", "string")


def _number(node: Column) -> Column:
    return F.try_variant_get(node, "$", "double")


def _is_text(node: Column) -> Column:
    return _kind(node) == "STRING"


def _is_number(node: Column) -> Column:
    return _kind(node).isin("BIGINT", "DOUBLE", "FLOAT") | _kind(node).startswith("DECIMAL")


_TYPES = {
    "object": lambda node: _kind(node).startswith("OBJECT"),
    "array": lambda node: _kind(node).startswith("ARRAY"),
    "string": _is_text,
    "number": _is_number,
    "integer": lambda node: _is_number(node) & (_number(node) == F.floor(_number(node))),
    "boolean": lambda node: _kind(node) == "BOOLEAN",
    "null": lambda node: _kind(node) == "VOID",
}


def _type(wanted, node: Column) -> Column:
    names = [wanted] if isinstance(wanted, str) else wanted
    if set(names) - set(_TYPES):
        raise ValueError(f"unknown type among {names}")
    return reduce(or_, [_TYPES[n](node) for n in names])


def _enum(values: list, node: Column) -> Column:
    """Texts, numbers, booleans and null."""
    texts = [v for v in values if isinstance(v, str)]
    truths = [v for v in values if isinstance(v, bool)]
    numbers = [float(v) for v in values if isinstance(v, int | float) and not isinstance(v, bool)]
    if len(texts) + len(truths) + len(numbers) + values.count(None) < len(values):
        raise ValueError("an enum of objects or arrays cannot be judged")
    found = _TYPES["null"](node) if None in values else F.lit(False)
    found = found | (_is_text(node) & _text(node).isin(*texts)) if texts else found
    found = found | (_is_number(node) & _number(node).isin(*numbers)) if numbers else found
    boolean = F.try_variant_get(node, "$", "boolean")
    return found | (_TYPES["boolean"](node) & boolean.isin(*truths)) if truths else found


def _format(name: str, node: Column) -> Column:
    if name not in FORMATS:
        raise ValueError(f"unknown format {name!r}")
    return ~_is_text(node) | FORMATS[name](_text(node))


def _of_number(holds):
    return lambda limit, node: ~_is_number(node) | holds(_number(node), F.lit(float(limit)))


def _of_text(holds):
    return lambda limit, node: ~_is_text(node) | holds(_text(node), limit)


def _of_items(holds):
    def check(limit, node):
        size = F.size(F.try_variant_get(node, "$", "array<variant>"))
        return ~_TYPES["array"](node) | holds(size, limit)

    return check


#: A keyword judges values of its own kind only, as the standard has it.
_KEYWORDS = {
    "type": _type,
    "enum": _enum,
    "const": lambda value, node: _enum([value], node),
    "format": _format,
    "minimum": _of_number(lambda v, limit: v >= limit),
    "maximum": _of_number(lambda v, limit: v <= limit),
    "exclusiveMinimum": _of_number(lambda v, limit: v > limit),
    "exclusiveMaximum": _of_number(lambda v, limit: v < limit),
    "minLength": _of_text(lambda v, limit: F.char_length(v) >= limit),
    "maxLength": _of_text(lambda v, limit: F.char_length(v) <= limit),
    "pattern": _of_text(lambda v, pattern: v.rlike(pattern)),
    "minItems": _of_items(lambda v, limit: v >= limit),
    "maxItems": _of_items(lambda v, limit: v <= limit),
}
