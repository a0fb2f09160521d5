"""Filter documents (F15, K9, A15): nested documents of comparisons compiled to Columns, one or a whole table of them.

``{"stars": {"$gte": 10}, "$or": [{"language": "Go"}, {"topics": {"$in": ["web"]}}]}`` and so on. A field that is null, or that the
table does not have, is missing: it equals null, differs from every value and compares with none. A field that holds a list
meets a condition where one of its elements does. Values of another kind than the field's never compare.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry._workers import ship_by_value
from quarry.session import materialize

ship_by_value(__name__)

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
#: Filters, or shapes of filters, that one pass takes; conditions that one expression holds.
MOST, TOGETHER = 10_000, 100


def _field(schema: T.StructType, path: str) -> tuple[Column, T.DataType] | None:
    """The column and type of a dotted path, or None where the table does not have it."""
    column, kind = None, schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return None
        column = F.col(f"`{part}`") if column is None else column.getField(part)
        kind = kind[part].dataType
    return column, kind


class Slot:
    """A value that a column holds instead of the document; ``like`` is a value of its type."""

    def __init__(self, column: Column, like):
        self.column, self.like = column, like


def _same_kind(kind: T.DataType, value) -> bool:
    value = value.like if isinstance(value, Slot) else value
    if isinstance(value, bool):
        return isinstance(kind, T.BooleanType)
    if isinstance(value, (int, float)):
        return isinstance(kind, NUMBERS)
    if isinstance(value, str):
        return isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))
    return False


def _literal(kind: T.DataType, value) -> Column:
    column = value.column if isinstance(value, Slot) else F.lit(value)
    return column.try_cast(kind) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else column


def _one(column: Column, kind: T.DataType, op: str, value) -> Column:
    """A condition on one value. Null counts as false, so that plain comparisons reach the scan; ``_not`` minds it."""
    if op == "$in":
        return reduce(or_, (_one(column, kind, "$eq", v) for v in value), F.lit(False))
    if value is None:
        return column.isNull() if op in ("$eq", "$gte", "$lte") else F.lit(False)
    if op == "$regex":
        return column.rlike(value) if isinstance(kind, T.StringType) else F.lit(False)
    if not _same_kind(kind, value):
        return F.lit(False)
    other = _literal(kind, value)
    return {"$eq": lambda: column == other, "$gt": lambda: column > other, "$gte": lambda: column >= other, "$lt": lambda: column < other, "$lte": lambda: column <= other}[op]()


def _not(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(False))


def _condition(found, op: str, value) -> Column:
    if op == "$ne":
        return _not(_condition(found, "$eq", value))
    if op == "$nin":
        return _not(_condition(found, "$in", value))
    if op == "$not":
        return _not(_conditions(found, value))
    if op == "$exists":
        there = F.lit(False) if found is None else found[0].isNotNull()
        return there if value else ~there
    if op not in ("$eq", "$gt", "$gte", "$lt", "$lte", "$in", "$regex", "$size", "$all"):
        raise ValueError(f"unknown operator {op}")
    if found is None:
        return F.lit(None in value if op == "$in" else value is None and op in ("$eq", "$gte", "$lte"))
    column, kind = found
    if op == "$size":
        return (F.size(column) == value) & column.isNotNull() if isinstance(kind, T.ArrayType) else F.lit(False)
    if op == "$all":
        return reduce(and_, (_condition(found, "$eq", v) for v in value)) if value else F.lit(False)
    if not isinstance(kind, T.ArrayType):
        return _one(column, kind, op, value)
    missing = _one(column, kind, op, value) if value is None or op == "$in" and None in value else F.lit(False)
    if isinstance(value, list) and op == "$eq":
        return column == F.array(*[F.lit(v) for v in value]).cast(kind)
    return missing | F.exists(column, lambda x: _one(x, kind.elementType, op, value))


def _conditions(found, asked) -> Column:
    if not (isinstance(asked, dict) and any(k.startswith("$") for k in asked)):
        return _condition(found, "$eq", asked)
    asked = dict(asked)
    options = asked.pop("$options", "")
    if "$regex" in asked and options:
        asked["$regex"] = f"(?{options}){asked['$regex']}"
    return reduce(and_, (_condition(found, op, v) for op, v in asked.items()), F.lit(True))


def compile_filter(document: dict, schema: T.StructType) -> Column:
    """The document as a condition, in which null counts as false; an empty document is true."""
    parts = []
    for name, asked in document.items():
        if name in ("$and", "$or", "$nor"):
            inner = [compile_filter(d, schema) for d in asked]
            if not inner:
                raise ValueError(f"{name} needs documents")
            joined = reduce(and_ if name == "$and" else or_, inner)
            parts.append(_not(joined) if name == "$nor" else joined)
        elif name.startswith("$"):
            raise ValueError(f"unknown operator {name}")
        else:
            parts.append(_conditions(_field(schema, name), asked))
    return reduce(and_, parts, F.lit(True))


def find(df: DataFrame, document: dict) -> DataFrame:
    """The rows that a document asks for; the comparisons reach the scan where the source takes them."""
    return df.filter(compile_filter(document, df.schema))


def find_all(df: DataFrame, filters: Iterable[tuple[object, dict]]) -> DataFrame:
    """``filter_id`` and the row, for each filter and each row that it asks for: one scan for all filters."""
    filters = list(filters)
    if len(filters) > MOST:
        raise ValueError(f"{len(filters)} filters; one pass takes {MOST}")
    if not filters:
        return df.select(F.lit(None).cast("string").alias("filter_id"), "*").limit(0)
    hits = [F.when(compile_filter(d, df.schema), F.lit(i)) for i, d in filters]
    together = [F.array_compact(F.array(*hits[k : k + TOGETHER])) for k in range(0, len(hits), TOGETHER)]
    return df.select(F.explode(F.concat(*together)).alias("filter_id"), "*")


#: What a slot holds: its name, a value of its type, and its place among a filter's values.
SLOTS = {"int": 0, "double": 0.0, "string": ""}
DEALT = 16                                             # rows that meet on one value or range are dealt to so many tasks
ASKED = 1000                                           # lists are cut down to what filters ask for, where that is no more strings than this


def _cut(document: dict, values: list) -> dict:
    """The document with its compared numbers and strings replaced by ``{"$slot": [type, place]}``, their values appended to ``values``."""
    def slot(v):
        kind = {int: "int", float: "double", str: "string"}.get(type(v))
        if kind is None or kind == "int" and not -(1 << 31) <= v < 1 << 31:
            return v
        values.append((v if kind == "int" else None, v if kind == "double" else None, v if kind == "string" else None))
        return {"$slot": [kind, len(values) - 1]}

    def asked(a):
        if not (isinstance(a, dict) and any(k.startswith("$") for k in a)):
            return slot(a)
        return {op: asked(v) if op == "$not" else [slot(x) for x in v] if op in ("$in", "$nin", "$all") else slot(v) if op in ("$eq", "$ne", "$gt", "$gte", "$lt", "$lte") else v for op, v in a.items()}

    return {name: [_cut(d, values) for d in a] if name in ("$and", "$or", "$nor") else asked(a) for name, a in document.items()}


def _shapes(batches):
    import pandas as pd

    for pdf in batches:
        shapes, held = [], []
        for text in pdf["_document"]:
            values: list = []
            shapes.append(json.dumps(_cut(json.loads(text), values)))
            held.append([{"int": i, "double": d, "string": t} for i, d, t in values])
        yield pd.DataFrame({"_place": pdf["_place"], "_shape": shapes, "_values": held})


def _filled(shape, slots: list):
    """A shape as a document again, its slots read from columns; these are appended to ``slots``."""
    if isinstance(shape, list):
        return [_filled(x, slots) for x in shape]
    if not isinstance(shape, dict):
        return shape
    if list(shape) == ["$slot"]:
        kind, place = shape["$slot"]
        slots.append(F.col("_values")[place][kind].alias(f"_slot{place}"))
        return Slot(F.col(f"_slot{place}"), SLOTS[kind])
    return {k: _filled(v, slots) for k, v in shape.items()}


def _meeting(document: dict, schema: T.StructType) -> tuple[Column, Column, Column] | None:
    """A comparison that all rows of a shape's filters meet: the field, and the least and the largest value that it can have."""
    whole = (T.ByteType, T.ShortType, T.IntegerType)
    for name, asked in document.items():
        found = None if name.startswith("$") else _field(schema, name)
        if found is None or not isinstance(found[1], whole):
            continue
        asked = asked if isinstance(asked, dict) else {"$eq": asked}
        ends = [[v.column for op in ops if isinstance(v := asked.get(op), Slot) and v.like == 0] for ops in (("$eq", "$gte", "$gt"), ("$eq", "$lte", "$lt"))]
        if all(ends):
            return found[0].cast("long"), ends[0][0].cast("long"), ends[1][0].cast("long")
    return None


class Cut:
    """A table of filters, staged as ``(filter_id, _shape, _values)``, and its shapes."""

    def __init__(self, held: DataFrame, shapes: list[str]):
        self.held, self.shapes = held, shapes


def cut_filters(filters: DataFrame, *, key: str = "filter_id", document: str = "document") -> Cut:
    """The filters by their shapes, for ``find_table`` and ``as_asked``."""
    rows = filters.repartition(filters.sparkSession.sparkContext.defaultParallelism).select(F.struct(key).alias("_place"), F.col(document).alias("_document"))
    place = T.StructType([T.StructField("_place", rows.schema["_place"].dataType), T.StructField("_shape", T.StringType()),
                          T.StructField("_values", T.ArrayType(T.StructType([T.StructField("int", T.IntegerType()), T.StructField("double", T.DoubleType()), T.StructField("string", T.StringType())])))])
    held = materialize(rows.select("_place", "_document").mapInPandas(_shapes, place).select(F.col("_place")[key].alias("filter_id"), "_shape", "_values"), "filters")
    shapes = [r["_shape"] for r in held.select("_shape").distinct().limit(MOST + 1).collect()]
    if len(shapes) > MOST:
        raise ValueError(f"more than {MOST} shapes of filters")
    return Cut(held, shapes)


def _uses(document: dict):
    """``(field, operator, value)`` of all that a document or a shape compares."""
    for name, asked in document.items():
        if name in ("$and", "$or", "$nor"):
            for d in asked:
                yield from _uses(d)
        elif isinstance(asked, dict) and any(k.startswith("$") for k in asked) and list(asked) != ["$slot"]:
            for op, value in asked.items():
                yield from _uses({name: value}) if op == "$not" else [(name, op, value)]
        else:
            yield name, "$eq", asked


def as_asked(df: DataFrame, filters: Cut) -> list[Column]:
    """The columns that the filters read, as far as they read them: rows that agree in these are asked for by the same filters.

    A string or number that is only compared with null tells whether there is one, and a list that is only searched for strings keeps
    those that some filter asks for (where these are at most ASKED).
    """
    uses: dict[str, list] = {}
    for shape in filters.shapes:
        for path, op, value in _uses(json.loads(shape)):
            name = path.split(".")[0]
            if name in df.columns:
                uses.setdefault(name, []).append((shape, path, op, value))

    def slots(op, value):
        """The places of the slots of a search for strings, or None where the condition is another one."""
        found = value if op in ("$in", "$nin") else [value] if op in ("$eq", "$ne") else [None]
        return [v["$slot"] for v in found] if all(isinstance(v, dict) and list(v) == ["$slot"] for v in found) else None

    searched = {name: [(shape, place) for shape, _, op, value in of for _, place in slots(op, value)] for name, of in uses.items()
                if df.schema[name].dataType in (T.ArrayType(T.StringType()), T.ArrayType(T.StringType(), False)) and all(path == name and slots(op, value) is not None for _, path, op, value in of)}
    wanted: dict[str, list] = {name: [] for name in searched}
    if any(searched.values()):
        places = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(shape).alias("_shape"), F.lit(place).alias("place")) for name, of in searched.items() for shape, place in of])
        places = df.sparkSession.range(1).select(F.inline(places))
        values = filters.held.select("_shape", F.posexplode("_values").alias("place", "value")).join(F.broadcast(places), ["_shape", "place"]).select("name", "value.string").distinct()
        for row in values.filter("string IS NOT NULL").limit(ASKED + 1).collect():
            wanted[row["name"]].append(row["string"])
    few = sum(map(len, wanted.values())) <= ASKED
    out = []
    for name, of in uses.items():
        column, kind = F.col(f"`{name}`"), df.schema[name].dataType
        if isinstance(kind, (T.StringType, *NUMBERS)) and all(path == name and (op == "$exists" or op in ("$eq", "$ne") and value is None) for _, path, op, value in of):
            column = F.when(column.isNotNull(), F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind))
        elif name in searched and few:
            column = F.array_sort(F.array_intersect(column, F.array(*map(F.lit, sorted(wanted[name]))).cast(kind)))
        out.append(column.alias(name))
    return out


def find_table(df: DataFrame, filters: DataFrame | Cut, *, key: str = "filter_id", document: str = "document", few: bool = False) -> DataFrame:
    """``find_all`` for a table of filters with their documents as JSON: one join for each shape of document, of which there may be at most MOST.

    Documents that differ in compared numbers and strings alone have one shape; its condition is compiled once and reads these from the filter's row.
    Where a shape compares a whole number with bounds, rows and filters meet on ranges about as wide as the filters' own; the rows are dealt
    to tasks and the filters of their range go to each, or the other way where rows are ``few``.
    """
    filters = filters if isinstance(filters, Cut) else cut_filters(filters, key=key, document=document)
    held = filters.held
    if not filters.shapes:
        return find_all(df, [])
    parts = []
    for shape in filters.shapes:
        slots: list = []
        asked = _filled(json.loads(shape), slots)
        own = held.filter(F.col("_shape") == shape).select("filter_id", *slots)
        met = _meeting(asked, df.schema)
        left = df.select(F.struct("*").alias("_row"), "*")
        if met is None:
            joined = left.join(own)
        else:
            field, low, high = met
            width = own.agg(F.greatest(F.lit(1), F.ceil(F.avg(F.when(high >= low, high - low)))).alias("_width"))       # one row
            own = own.filter(high >= low).join(F.broadcast(width)).withColumn("_range", F.explode(F.sequence(F.floor(low / F.col("_width")), F.floor(high / F.col("_width"))))).drop("_width")
            left = left.join(F.broadcast(width)).withColumn("_range", F.floor(field / F.col("_width")))
            to_all, to_one = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))), F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)).cast("int")
            own, left = own.withColumn("_deal", to_one if few else to_all), left.withColumn("_deal", to_all if few else to_one)
            joined = left.join(own.hint("merge"), ["_range", "_deal"])
        parts.append(joined.filter(compile_filter(asked, df.schema)).select("filter_id", "_row.*"))
    return reduce(DataFrame.unionByName, parts)
