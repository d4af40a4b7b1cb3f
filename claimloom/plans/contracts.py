"""JSON-Schema contracts compiled to a check of JSON text columns.

The compiler reads a schema once on the driver, resolves its pointers and refuses keywords
that it doesn't know, so that no rule is passed over in silence. All keywords of a schema count,
also beside ``oneOf``.

A schema becomes one Column over the parsed text (a VARIANT): a place in it is a path, items are
higher-order functions, branches are counts of fitting ones. Only a schema that refers to itself
has no finite expression; its documents are checked by the same rules in Python, in Arrow batches.
The two agree but for the order of members: a VARIANT has none, so constants and repeated items
compare objects by content there, and surplus members are told in order of their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.functions.values import RFC3339

Rule = Callable[[object, str], list[str]]
_QUIET = {"$schema", "$id", "$defs", "definitions", "title", "description", "examples", "default", "$comment"}


class UnknownKeyword(ValueError):
    """A schema keyword that the compiler has no rule for."""


def pointer(document, ref: str):
    """What a JSON pointer (``#/a/b``) leads to, with its two escapes."""
    at = document
    for part in ref.lstrip("#").split("/")[1:]:
        part = part.replace("~1", "/").replace("~0", "~")
        at = at[int(part)] if isinstance(at, list) else at[part]
    return at


def json_type(x) -> str:
    if isinstance(x, bool):
        return "boolean"
    if isinstance(x, int) or isinstance(x, float) and x.is_integer():
        return "integer"
    return {float: "number", str: "string", list: "array", dict: "object", type(None): "null"}[type(x)]


def _same(a, b) -> bool:
    """Deep equality, the order of keys included; true and 1 differ, 1 and 1.0 don't."""
    return json.dumps(_whole(a)) == json.dumps(_whole(b))


def _whole(x):
    if isinstance(x, list):
        return [_whole(y) for y in x]
    if isinstance(x, dict):
        return {k: _whole(y) for k, y in x.items()}
    return int(x) if isinstance(x, float) and x.is_integer() else x


def _date_time(x: str, strict: bool) -> bool:
    if strict and not re.fullmatch(RFC3339, x):
        return False
    try:
        datetime.fromisoformat(x.replace("Z", "+00:00"))
        return True
    except ValueError:
        return False


def compile_schema(schema: dict, registry: dict[str, dict] | None = None, strict_dates: bool = True) -> Rule:
    """The rule ``(value, place) -> problems`` of a schema; ``registry`` has other schema documents by name."""
    registry = registry or {}
    done: dict[int, Rule] = {}

    def resolve(ref: str, root: dict) -> tuple[dict, dict]:
        name, _, inner = ref.partition("#")
        other = registry[name.rsplit("/", 1)[-1]] if name else root
        return (pointer(other, "#" + inner) if inner else other), other

    def build(s, root: dict) -> Rule:
        if isinstance(s, bool):
            return lambda v, at: [] if s else [f"{at}: not allowed"]
        if id(s) in done:
            return lambda v, at, key=id(s): done[key](v, at)
        done[id(s)] = lambda v, at: []
        parts = [rule(k, x, s, root) for k, x in s.items() if k not in _QUIET and k not in ("then", "else", "minContains", "maxContains")]
        done[id(s)] = lambda v, at: [p for r in parts for p in r(v, at)]
        return done[id(s)]

    def rule(k: str, x, s: dict, root: dict) -> Rule:
        of = lambda kind, test, say: lambda v, at: [] if not isinstance(v, kind) or isinstance(v, bool) and kind is not bool or test(v) else [f"{at}: {say}"]
        number = (int, float)
        simple = {
            "minLength": lambda: of(str, lambda v: len(v) >= x, f"shorter than {x}"), "maxLength": lambda: of(str, lambda v: len(v) <= x, f"longer than {x}"), "pattern": lambda: of(str, lambda v, p=re.compile(x): p.search(v), f"doesn't match {x}"),
            "minimum": lambda: of(number, lambda v: v >= x, f"below {x}"), "maximum": lambda: of(number, lambda v: v <= x, f"above {x}"), "exclusiveMinimum": lambda: of(number, lambda v: v > x, f"not above {x}"), "multipleOf": lambda: of(number, lambda v: v % x == 0, f"no multiple of {x}"),
            "minItems": lambda: of(list, lambda v: len(v) >= x, f"fewer than {x} items"), "maxItems": lambda: of(list, lambda v: len(v) <= x, f"more than {x} items"), "minProperties": lambda: of(dict, lambda v: len(v) >= x, f"fewer than {x} members"),
            "uniqueItems": lambda: of(list, lambda v: not x or len({json.dumps(i, sort_keys=True) for i in v}) == len(v), "items repeat"),
            "format": lambda: of(str, lambda v: _date_time(v, strict_dates) if x == "date-time" else v.startswith(("http://", "https://", "urn:")) if x == "uri" else True, f"no {x}"),
            "const": lambda: lambda v, at: [] if _same(v, x) else [f"{at}: not the constant"], "enum": lambda: lambda v, at: [] if any(_same(v, y) for y in x) else [f"{at}: not in the list"],
            "required": lambda: lambda v, at: [f"{at}.{m}: missing" for m in x if isinstance(v, dict) and m not in v],
        }
        if k in simple:
            return simple[k]()
        if k == "type":
            kinds = {x} if isinstance(x, str) else set(x)
            return lambda v, at: [] if json_type(v) in kinds or json_type(v) == "integer" and "number" in kinds else [f"{at}: not {'/'.join(sorted(kinds))}"]
        if k == "$ref":
            target, other = resolve(x, root)
            return build(target, other)
        if k == "properties":
            inner = {n: build(y, root) for n, y in x.items()}
            return lambda v, at: [p for n, r in inner.items() if isinstance(v, dict) and n in v for p in r(v[n], f"{at}.{n}")]
        if k == "additionalProperties":
            known, extra = set(s.get("properties", {})), build(x, root)
            return lambda v, at: [p for n in v if n not in known for p in extra(v[n], f"{at}.{n}")] if isinstance(v, dict) else []
        if k == "propertyNames":
            inner_rule = build(x, root)
            return lambda v, at: [p for n in v for p in inner_rule(n, f"{at}.{n}")] if isinstance(v, dict) else []
        if k == "items":
            inner_rule = build(x, root)
            return lambda v, at: [p for i, y in enumerate(v) for p in inner_rule(y, f"{at}[{i}]")] if isinstance(v, list) else []
        if k == "contains":
            inner_rule, least, most = build(x, root), s.get("minContains", 1), s.get("maxContains", float("inf"))
            return lambda v, at: [f"{at}: items that match are too few or many"] if isinstance(v, list) and not least <= sum(not inner_rule(y, at) for y in v) <= most else []
        if k in ("allOf", "anyOf", "oneOf"):
            rules = [build(y, root) for y in x]
            if k == "allOf":
                return lambda v, at: [p for r in rules for p in r(v, at)]
            fits = lambda v, at: sum(not r(v, at) for r in rules)
            return (lambda v, at: [] if fits(v, at) >= 1 else [f"{at}: fits none"]) if k == "anyOf" else (lambda v, at: [] if fits(v, at) == 1 else [f"{at}: doesn't fit exactly one"])
        if k == "not":
            inner_rule = build(x, root)
            return lambda v, at: [] if inner_rule(v, at) else [f"{at}: must not fit"]
        if k == "if":
            test, yes, no = build(x, root), build(s.get("then", True), root), build(s.get("else", True), root)
            return lambda v, at: no(v, at) if test(v, at) else yes(v, at)
        raise UnknownKeyword(k)

    return build(schema, schema)


class _Recursive(ValueError):
    """A schema that refers to itself."""


class _Place:
    """A value within a VARIANT column: its path, and how problems name it."""

    def __init__(self, root: Column, path: str, at: Column):
        self.root, self.path, self.at = root, path, at

    def get(self, kind: str = "variant") -> Column:
        return F.try_variant_get(self.root, self.path, kind)

    def member(self, name: str) -> _Place:
        at = F.concat(self.at, F.lit(f".{name}"))
        if "'" in name and '"' in name:  # no path can name it
            held = F.filter(F.map_entries(self.get("map<string,variant>")), lambda e: e["key"] == name)
            return _Place(F.get(held, F.lit(0))["value"], "$", at)
        mark = '"' if "'" in name else "'"
        return _Place(self.root, f"{self.path}[{mark}{name}{mark}]", at)

    def is_(self, *kinds: str) -> Column:
        """Whether the value has one of these JSON types."""
        told = F.schema_of_variant(self.get())
        numeric = told.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        number = self.get("double")
        tests = {"object": told.startswith("OBJECT<"), "array": told.startswith("ARRAY<"), "string": told == "STRING", "boolean": told == "BOOLEAN", "null": told == "VOID", "number": numeric, "integer": numeric & (number % 1 == 0)}
        out = F.lit(False)
        for k in kinds:
            out = out | tests[k]
        return F.coalesce(out, F.lit(False))


_TEXTS = "array<string>"


def compile_columns(schema: dict, registry: dict[str, dict] | None = None, strict_dates: bool = True) -> Callable[[Column], Column]:
    """The expression of a schema: from a VARIANT column an array of problems, as :func:`compile_schema` words them."""
    registry = registry or {}
    none = F.array().cast(_TEXTS)

    def resolve(ref: str, root: dict) -> tuple[dict, dict]:
        name, _, inner = ref.partition("#")
        other = registry[name.rsplit("/", 1)[-1]] if name else root
        return (pointer(other, "#" + inner) if inner else other), other

    def joined(parts: list[Column]) -> Column:
        return F.concat(*parts) if len(parts) > 1 else parts[0] if parts else none

    def one(bad: Column, at: Column, say: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(False)), F.array(F.concat(at, F.lit(say)))).otherwise(none)

    def build(s, root: dict, v: _Place, above: tuple) -> Column:
        if isinstance(s, bool):
            return none if s else F.array(F.concat(v.at, F.lit(": not allowed")))
        if id(s) in above:
            raise _Recursive(str(s.get("$ref", "")))
        above = (*above, id(s))
        return joined([rule(k, x, s, root, v, above) for k, x in s.items() if k not in _QUIET and k not in ("then", "else", "minContains", "maxContains")])

    def fits(s, root: dict, v: _Place, above: tuple) -> Column:
        return F.size(build(s, root, v, above)) == 0

    def equals(v: _Place, x) -> Column:
        if isinstance(x, bool):
            return v.is_("boolean") & (v.get("boolean") == x)
        if isinstance(x, (int, float)):
            return v.is_("number") & (v.get("double") == float(x))
        if isinstance(x, str):
            return v.is_("string") & (v.get("string") == x)
        return F.coalesce(F.to_json(v.get()) == F.to_json(F.parse_json(F.lit(json.dumps(x)))), F.lit(False))

    def entries(v: _Place, each: Callable[[_Place, Column], Column], but: list[str]) -> Column:
        """What ``each`` finds in members other than ``but``, in order of their names."""
        held = F.map_entries(v.get("map<string,variant>"))
        other = F.array_sort(F.filter(F.map_keys(v.get("map<string,variant>")), lambda n: ~n.isin(but) if but else F.lit(True)))
        named = lambda n: F.get(F.filter(held, lambda e: e["key"] == n), F.lit(0))["value"]
        return F.coalesce(F.flatten(F.transform(other, lambda n: each(_Place(named(n), "$", F.concat(v.at, F.lit("."), n)), n))), none)

    def rule(k: str, x, s: dict, root: dict, v: _Place, above: tuple) -> Column:
        text, number, items = lambda: v.get("string"), lambda: v.get("double"), lambda: v.get("array<variant>")
        strings, numbers, arrays = (lambda bad, say, kind=kind: one(v.is_(kind) & bad, v.at, f": {say}") for kind in ("string", "number", "array"))
        simple = {
            "minLength": lambda: strings(F.length(text()) < x, f"shorter than {x}"), "maxLength": lambda: strings(F.length(text()) > x, f"longer than {x}"), "pattern": lambda: strings(~text().rlike(x), f"doesn't match {x}"),
            "minimum": lambda: numbers(number() < x, f"below {x}"), "maximum": lambda: numbers(number() > x, f"above {x}"), "exclusiveMinimum": lambda: numbers(number() <= x, f"not above {x}"), "multipleOf": lambda: numbers(number() % x != 0, f"no multiple of {x}"),
            "minItems": lambda: arrays(F.size(items()) < x, f"fewer than {x} items"), "maxItems": lambda: arrays(F.size(items()) > x, f"more than {x} items"),
            "minProperties": lambda: one(v.is_("object") & (F.size(F.map_keys(v.get("map<string,variant>"))) < x), v.at, f": fewer than {x} members"),
            "uniqueItems": lambda: arrays(F.size(F.array_distinct(F.transform(items(), lambda i: F.to_json(i)))) < F.size(items()), "items repeat") if x else none,
            "format": lambda: strings(~_formatted(text(), x, strict_dates), f"no {x}"), "const": lambda: one(~equals(v, x), v.at, ": not the constant"),
            "enum": lambda: F.when(_any([equals(v, y) for y in x]), none).otherwise(F.array(F.concat(v.at, F.lit(": not in the list")))),
            "required": lambda: joined([one(v.is_("object") & v.member(m).get().isNull(), v.at, f".{m}: missing") for m in x]),
        }
        if k in simple:
            return simple[k]()
        if k == "type":
            kinds = [x] if isinstance(x, str) else list(x)
            return one(~v.is_(*kinds), v.at, f": not {'/'.join(sorted(set(kinds)))}")
        if k == "$ref":
            target, other = resolve(x, root)
            return build(target, other, v, above)
        if k == "properties":
            inner = [(v.member(n), y) for n, y in x.items()]
            return joined([F.when(v.is_("object") & m.get().isNotNull(), build(y, root, m, above)).otherwise(none) for m, y in inner])
        if k == "additionalProperties":
            known = list(s.get("properties", {}))
            return F.when(v.is_("object"), entries(v, lambda m, _: build(x, root, m, above), known)).otherwise(none)
        if k == "propertyNames":
            return F.when(v.is_("object"), entries(v, lambda m, n: build(x, root, _Place(n.cast("variant"), "$", m.at), above), [])).otherwise(none)
        if k == "items":
            place = lambda y, i: _Place(y, "$", F.concat(v.at, F.lit("["), i.cast("string"), F.lit("]")))
            return F.when(v.is_("array"), F.flatten(F.transform(items(), lambda y, i: build(x, root, place(y, i), above)))).otherwise(none)
        if k == "contains":
            n = F.size(F.filter(items(), lambda y: fits(x, root, _Place(y, "$", v.at), above)))
            bad = n < s.get("minContains", 1)
            return arrays(bad | (n > s["maxContains"]) if "maxContains" in s else bad, "items that match are too few or many")
        if k == "allOf":
            return joined([build(y, root, v, above) for y in x])
        if k in ("anyOf", "oneOf"):
            n = sum((fits(y, root, v, above).cast("int") for y in x), F.lit(0))
            return one(n < 1, v.at, ": fits none") if k == "anyOf" else one(n != 1, v.at, ": doesn't fit exactly one")
        if k == "not":
            return one(fits(x, root, v, above), v.at, ": must not fit")
        if k == "if":
            return F.when(fits(x, root, v, above), build(s.get("then", True), root, v, above)).otherwise(build(s.get("else", True), root, v, above))
        raise UnknownKeyword(k)

    build(schema, schema, _Place(F.lit(None).cast("variant"), "$", F.lit("$")), ())
    return lambda column: build(schema, schema, _Place(column, "$", F.lit("$")), ())


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for x in tests:
        out = out | F.coalesce(x, F.lit(False))
    return out


def _formatted(text: Column, form: str, strict_dates: bool) -> Column:
    if form == "uri":
        return text.rlike("^(?:https?://|urn:)")
    if form != "date-time":
        return F.lit(True)
    moment = F.try_to_timestamp(text).isNotNull()
    return text.rlike(RFC3339) & moment if strict_dates else moment


def problems(column: Column, schema: dict, registry: dict[str, dict] | None = None, strict_dates: bool = True) -> Column:
    """An array of problems of each JSON text; empty if it keeps the contract. Null has one problem."""
    try:
        expression = compile_columns(schema, registry, strict_dates)
    except _Recursive:
        return python_problems(column, schema, registry, strict_dates)
    parsed = F.try_parse_json(column)
    one = lambda say: F.array(F.lit(say))
    return F.when(column.isNull(), one("$: missing")).when(parsed.isNull(), one("$: no JSON")).otherwise(expression(parsed))


def contract_problems(documents: DataFrame, schemas: dict[str, dict], registry: dict[str, dict] | None = None, strict_dates: bool = True) -> DataFrame:
    """``(schema, name, problem)`` of documents (schema, name, text), each checked by the schema that it names.

    The pairs are a table, so that a list of contracts is data. A document of a schema that isn't there has that problem.
    Schemas may refer to one another and to those of ``registry``.
    """
    told = F.array(F.lit("$: no such schema"))
    for name, schema in schemas.items():
        told = F.when(F.col("schema") == name, problems(F.col("text"), schema, schemas | (registry or {}), strict_dates)).otherwise(told)
    return documents.select("schema", "name", F.explode(told).alias("problem"))


def python_problems(column: Column, schema: dict, registry: dict[str, dict] | None = None, strict_dates: bool = True) -> Column:
    """:func:`problems` of a schema that refers to itself, by the rules of :func:`compile_schema`."""
    compile_schema(schema, registry, strict_dates)  # refuse unknown keywords before any row is read

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def check(texts: pd.Series) -> pd.Series:
        rule = compile_schema(schema, registry, strict_dates)

        def one(text):
            try:
                return rule(json.loads(text), "$") if text is not None else ["$: missing"]
            except ValueError as e:
                return [f"$: no JSON ({e})"]

        return texts.map(one)

    return check(column)
