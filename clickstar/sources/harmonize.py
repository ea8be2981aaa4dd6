"""One common nested schema for records whose fields change shape.

Where a field is a list in some records, the others are wrapped as lists of one; where it is an
object in some, plain values become ``{"_value": x}``; objects get the union of their keys, in
alphabetical order; scalars that differ become text.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .leaves import text_leaves, text_type

PLAIN_VALUE = "_value"
_LIST, _OBJECT, _MAP, _PLAIN, _NULL = "list", "object", "map", "plain", "null"
_ITEM, _ENTRY = 0, 1  # path steps into a list and into a map; keys are strings
# An object with more different keys than this, over all documents, is a map: its keys are data.
MAX_KEYS = 1_000


def common_scalar(a: T.DataType, b: T.DataType) -> T.DataType:
    """Smallest type that holds both: bool < int < float, date < timestamp, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    whole = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    number = (*whole, T.FloatType, T.DoubleType)
    moment = (T.DateType, T.TimestampType)
    if isinstance(a, whole) and isinstance(b, whole):
        return T.LongType()
    if isinstance(a, number) and isinstance(b, number):
        return T.DoubleType()
    if isinstance(a, moment) and isinstance(b, moment):
        return T.TimestampType()
    return T.StringType()


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both can be lifted to by the rules of this module."""
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        item_a = a.elementType if isinstance(a, T.ArrayType) else a
        item_b = b.elementType if isinstance(b, T.ArrayType) else b
        return T.ArrayType(common_type(item_a, item_b))
    if isinstance(a, T.StructType) or isinstance(b, T.StructType):
        def fields(t: T.DataType) -> dict[str, T.DataType]:
            if isinstance(t, T.StructType):
                return {f.name: f.dataType for f in t.fields}
            return {PLAIN_VALUE: t}

        left, right = fields(a), fields(b)
        return T.StructType([
            T.StructField(name, common_type(left.get(name, T.NullType()), right.get(name, T.NullType())))
            for name in sorted(left.keys() | right.keys())
        ])
    return common_scalar(a, b)


def lift(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Column of type ``source`` as ``target``, a type it has in common with others."""
    if source == target:
        return c
    if isinstance(source, T.NullType):
        return F.lit(None).cast(target)
    if isinstance(target, T.ArrayType):
        if isinstance(source, T.ArrayType):
            return F.transform(c, lambda x: lift(x, source.elementType, target.elementType))
        return F.when(c.isNotNull(), F.array(lift(c, source, target.elementType)))
    if isinstance(target, T.StructType):
        known = (
            {f.name: (c[f.name], f.dataType) for f in source.fields}
            if isinstance(source, T.StructType)
            else {PLAIN_VALUE: (c, source)}
        )
        fields = [
            lift(*known.get(f.name, (F.lit(None), T.NullType())), f.dataType).alias(f.name)
            for f in target.fields
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(target, T.StringType):
        return text_leaves(c, source)
    if isinstance(source, T.BooleanType) and isinstance(target, T.DoubleType):
        return c.cast("int").cast(target)
    return c.cast(target)


def union_harmonized(frames: Iterable[DataFrame]) -> DataFrame:
    """Union of typed frames whose columns differ in shape or type."""
    frames = list(frames)
    target: T.DataType = T.NullType()
    for frame in frames:
        target = common_type(target, frame.schema)
    target = common_type(target, T.StructType([]))

    def lifted(frame: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in frame.schema.fields}
        return frame.select(*[
            lift(F.col(f"`{f.name}`") if f.name in types else F.lit(None),
                 types.get(f.name, T.NullType()), f.dataType).alias(f.name)
            for f in target.fields
        ])

    result = lifted(frames[0])
    for frame in frames[1:]:
        result = result.unionByName(lifted(frame))
    return result


# --- JSON text -----------------------------------------------------------------------------


@dataclass
class _Shape:
    """What was seen at one place of the documents."""

    kinds: set[str] = field(default_factory=set)
    items: "_Shape | None" = None
    keys: dict[str, "_Shape"] = field(default_factory=dict)
    entries: "_Shape | None" = None

    def at(self, path: list) -> "_Shape":
        here = self
        for step in path:
            if step == _ITEM:
                here.items = here.items or _Shape()
                here = here.items
            elif step == _ENTRY:
                here.entries = here.entries or _Shape()
                here = here.entries
            else:
                here = here.keys.setdefault(step, _Shape())
        return here

    def absorb(self, other: "_Shape | None") -> "_Shape":
        if other is not None:
            self.kinds |= other.kinds
            for name, child in other.keys.items():
                self.keys[name] = _Shape().absorb(self.keys.get(name)).absorb(child)
            if other.items is not None:
                self.items = _Shape().absorb(self.items).absorb(other.items)
            if other.entries is not None:
                self.entries = _Shape().absorb(self.entries).absorb(other.entries)
        return self

    def list_item(self) -> "_Shape":
        """Shape of the elements once everything here is a list."""
        wrapped = _Shape(self.kinds - {_LIST, _NULL}, None, self.keys, self.entries)
        return _Shape().absorb(wrapped).absorb(self.items)

    def entry(self) -> "_Shape":
        """Shape of the values of a map; a plain value in its place is the entry ``_value``."""
        plain = _Shape({_PLAIN}) if _PLAIN in self.kinds else None
        return _Shape().absorb(self.entries).absorb(plain)

    def mixed(self) -> bool:
        return len(self.kinds - {_NULL}) > 1

    def target(self) -> T.DataType:
        if _LIST in self.kinds:
            return T.ArrayType(self.list_item().target())
        if _MAP in self.kinds:
            return T.MapType(T.StringType(), self.entry().target())
        if _OBJECT in self.kinds:
            children = {name: child.target() for name, child in self.keys.items()}
            if _PLAIN in self.kinds:
                children[PLAIN_VALUE] = common_type(children.get(PLAIN_VALUE, T.NullType()), T.StringType())
            return T.StructType([T.StructField(name, children[name]) for name in sorted(children)])
        return T.StringType()

    def parsed(self) -> T.DataType:
        """Type to parse with: places of mixed shape stay variants, the others are exact."""
        if self.mixed():
            return T.VariantType()
        if _LIST in self.kinds:
            return T.ArrayType((self.items or _Shape()).parsed())
        if _MAP in self.kinds:
            return T.MapType(T.StringType(), (self.entries or _Shape()).parsed())
        if _OBJECT in self.kinds:
            return T.StructType([T.StructField(n, self.keys[n].parsed()) for n in sorted(self.keys)])
        return T.StringType()


def _paths(value: object, path: tuple, seen: set) -> None:
    if isinstance(value, dict):
        seen.add((path, _OBJECT))
        for name, child in value.items():
            _paths(child, (*path, name), seen)
    elif isinstance(value, list):
        seen.add((path, _LIST))
        for child in value:
            _paths(child, (*path, _ITEM), seen)
    else:
        seen.add((path, _NULL if value is None else _PLAIN))


def _seen_paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # The reader that admits a document stops at 1,000 levels.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 5_000))
    for batch in batches:
        seen: set = set()
        for text in batch["document"]:
            _paths(json.JSONDecoder().raw_decode(text.lstrip(" \t\n\r"))[0], (), seen)
        yield pd.DataFrame([(json.dumps(p), kind) for p, kind in seen], columns=["path", "kind"])


def _with_maps(seen: DataFrame, max_keys: int) -> DataFrame:
    """(path, kind) with the keys of objects that have more than ``max_keys`` of them as one step.

    The keys below a place are counted where the paths are; only the places with too many come to the
    driver.  Maps inside maps show when the outer keys are one, so this is repeated level by level.
    """
    known: set[str] = set()
    while True:
        now = seen.select(_mapped("path", sorted(known)).alias("path"), "kind").distinct() if known else seen
        parents = now.select(_parent("path").alias("parent"), "path").where("parent <> '[]'").distinct()
        wide = parents.groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_keys)
        # The shallowest first: what lies below has the keys of the outer map in its path.
        found = wide.select("parent", F.length("parent").alias("size")).orderBy("size", "parent").limit(100).collect()
        if not found:
            return now
        outer: list[list] = []
        for row in found:
            path = json.loads(row["parent"])
            if not any(path[: len(o)] == o for o in outer):
                outer.append(path)
        known |= {json.dumps(path) for path in outer}


@F.pandas_udf(T.StringType())
def _parent(paths: pd.Series) -> pd.Series:
    """The place that holds a key; None for the root, items of lists and entries of maps."""
    steps = paths.map(json.loads)
    return steps.map(lambda path: json.dumps(path[:-1]) if path and isinstance(path[-1], str) else None)


def _mapped(column: str, maps: list[str]) -> Column:
    """The path with the key after each of the given places replaced by the step into a map."""
    places = [json.loads(m) for m in maps]

    @F.pandas_udf(T.StringType())
    def replaced(paths: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            path = json.loads(text)
            for place in sorted(places, key=len):
                if len(path) > len(place) and path[: len(place)] == place and isinstance(path[len(place)], str):
                    path[len(place)] = _ENTRY
            return json.dumps(path)

        return paths.map(one)

    return replaced(F.col(column))


def document_shape(documents: DataFrame, column: str, max_keys: int = MAX_KEYS) -> _Shape:
    """Merged shape of all JSON documents that :func:`_readable` admits, so that a document has a say
    in the columns if and only if it becomes a row.

    Tasks emit each place they saw once per batch and a distinct follows.  Objects with more than
    ``max_keys`` keys over all documents, as those keyed by ids, become maps before anything comes to
    the driver, so it gets one row per place of the final schema, whatever the number of documents or
    of ids.  The fields of the documents themselves stay columns.
    """
    seen = cut_lineage(
        documents.where(_readable(column))
        .select(F.col(column).alias("document"))
        .mapInPandas(_seen_paths, "path string, kind string")
        .distinct()
    )
    root, places = _Shape(), []
    for row in _with_maps(seen, max_keys).toLocalIterator():
        path = json.loads(row["path"])
        root.at(path).kinds.add(row["kind"])
        places += [path[:i] for i, step in enumerate(path) if step == _ENTRY and isinstance(step, int)]
    for path in places:
        shape = root.at(path)
        shape.kinds = (shape.kinds - {_OBJECT}) | {_MAP}
    return root


def _is_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>").isNotNull()


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _from_variant(v: Column, shape: _Shape) -> Column:
    """Variant value of a mixed place → its target type."""
    missing = v.isNull() | F.is_variant_null(v)
    target = shape.target()
    if _LIST in shape.kinds:
        item = shape.list_item()
        listed = F.when(_is_list(v), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))
        return F.when(~missing, F.transform(listed, lambda x: _from_variant(x, item)))
    if _MAP in shape.kinds:
        entry = shape.entry()
        entries = F.transform_values(F.try_variant_get(v, "$", "map<string,variant>"), lambda _, x: _from_variant(x, entry))
        if _PLAIN in shape.kinds:
            plain = lift(F.try_variant_get(v, "$", "string"), T.StringType(), entry.target())
            entries = F.when(_is_object(v), entries).otherwise(F.create_map(F.lit(PLAIN_VALUE), plain))
        return F.when(~missing, entries)
    if _OBJECT in shape.kinds:
        fields = []
        for f in target.fields:
            child = shape.keys.get(f.name)
            inner = (
                _from_variant(F.try_variant_get(v, f"$[{json.dumps(f.name, ensure_ascii=False)}]", "variant"), child)
                if child is not None
                else F.lit(None).cast(f.dataType)
            )
            if f.name == PLAIN_VALUE and _PLAIN in shape.kinds:
                plain = lift(F.try_variant_get(v, "$", "string"), T.StringType(), f.dataType)
                inner = F.when(_is_object(v), inner).otherwise(plain)
            fields.append(inner.alias(f.name))
        return F.when(~missing, F.struct(*fields))
    return F.when(~missing, F.try_variant_get(v, "$", "string"))


def _project(c: Column, shape: _Shape) -> Column:
    if shape.mixed():
        return _from_variant(c, shape)
    if _LIST in shape.kinds:
        item = shape.items or _Shape()
        return F.transform(c, lambda x: _project(x, item))
    if _MAP in shape.kinds:
        entry = shape.entries or _Shape()
        return F.transform_values(c, lambda _, x: _project(x, entry))
    if _OBJECT in shape.kinds:
        return F.when(
            c.isNotNull(),
            F.struct(*[_project(c[name], shape.keys[name]).alias(name) for name in sorted(shape.keys)]),
        )
    return c


def _readable(column: str) -> Column:
    """Whether a text is one JSON object; false for NULL, broken text, repeated keys and NaN.

    White space of JSON may stand around it.  The parser ends with the first value it finds, so the
    text is read as the only item of a list.
    """
    text = F.btrim(F.col(column), F.lit(" \t\n\r"))
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = listed.isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()
    return F.coalesce(text.startswith("{") & text.endswith("}") & alone, F.lit(False))


def rejected_documents(documents: DataFrame, column: str) -> DataFrame:
    """Rows that :func:`harmonize_json` leaves out: no JSON object, broken or NULL."""
    return documents.where(~_readable(column))


def harmonize_json(
    documents: DataFrame, column: str, keep: Iterable[str] = (), max_keys: int = MAX_KEYS
) -> DataFrame:
    """JSON documents as one common struct schema with text leaves.

    Rows that are no readable object are left out (:func:`rejected_documents` has them); ``keep``
    names other columns to carry along.  Objects with more than ``max_keys`` different keys become maps
    (:func:`document_shape`).  The first pass finds the shape, the second parses with it: only places of mixed shape go
    through variants, all others are parsed straight into their type.
    """
    shape = document_shape(documents, column, max_keys)
    root = _Shape(shape.kinds & {_OBJECT}, None, shape.keys)
    parsed = documents.where(_readable(column)).select(
        *keep, F.from_json(column, root.parsed(), {"primitivesAsString": "true"}).alias("__document")
    )
    return parsed.select(
        *keep,
        *[_project(F.col("__document")[name], root.keys[name]).alias(name) for name in sorted(root.keys)],
    )


def harmonize_frame(df: DataFrame) -> DataFrame:
    """Typed nested columns → text leaves with alphabetical struct keys, as landing files have."""

    def ordered(t: T.DataType) -> T.DataType:
        if isinstance(t, T.StructType):
            return T.StructType([T.StructField(f.name, ordered(f.dataType)) for f in sorted(t.fields, key=lambda f: f.name)])
        if isinstance(t, T.ArrayType):
            return T.ArrayType(ordered(t.elementType))
        return t

    target = ordered(text_type(df.schema))
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[lift(text_leaves(F.col(f"`{f.name}`"), types[f.name]), text_type(types[f.name]), f.dataType).alias(f.name)
                       for f in target.fields])
