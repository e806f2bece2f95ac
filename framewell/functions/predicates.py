"""Query documents and condition text -> one Spark ``Column``.

The request is turned into a predicate once, on the driver; Catalyst then
pushes what it can to the scan. Null handling: a comparison with a null field
is false (SQL), except ``$ne`` / ``$nin``, which match nulls as a document
store does, and ``{field: None}``, which means "is null".
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.timefmt import parse_request_date_literal

_OBJECT_ID = re.compile(r"^[0-9a-fA-F]{24}$")


def is_object_id(text) -> bool:
    """T7 on a literal."""
    return isinstance(text, str) and bool(_OBJECT_ID.match(text))


def object_id_col(col) -> Column:
    """T7 on a column."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(r"^[0-9a-fA-F]{24}$")


def coerce_query(value, field: str = ""):
    """Request literals typed by the field they stand under.

    Text under a ``*_datetime`` field, directly or below operators and lists, becomes a
    datetime of the three request formats (ValueError names the field). A well-formed object
    id under ``_id``, directly or below operators and lists (T7), takes the form it is stored in, lower-case hex;
    other ids stay as they are.
    """
    if isinstance(value, dict):
        return {k: coerce_query(v, field if k.startswith("$") else k) for k, v in value.items()}
    if isinstance(value, list):
        return [coerce_query(v, field) for v in value]
    if field == "_id" and is_object_id(value):
        return value.lower()
    if isinstance(value, str) and field.endswith("_datetime"):
        try:
            return parse_request_date_literal(value)
        except ValueError as e:
            raise ValueError(f"{field}: {e}") from e
    return value


def _field_type(schema: T.StructType | None, path: str) -> T.DataType | None:
    if schema is None:
        return None
    dtype: T.DataType = schema
    for part in path.split("."):
        if isinstance(dtype, T.StructType) and part in dtype.fieldNames():
            dtype = dtype[part].dataType
        else:
            return None
    return dtype


def _lit(v, dtype: T.DataType | None) -> Column:
    if isinstance(v, Column):
        return v
    if dtype is None or isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.lit(v)
    if isinstance(v, str) and isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        v = parse_request_date_literal(v)
    return F.lit(v).cast(dtype)


def _compare(field, op: str, v, dtype) -> Column:
    c = F.col(field) if isinstance(field, str) else field
    elem = dtype.elementType if isinstance(dtype, T.ArrayType) else None
    if op == "$eq":
        if v is None:
            return c.isNull()
        if elem is not None and not isinstance(v, list):
            return F.array_contains(c, _lit(v, elem))
        return c == _lit(v, dtype)
    if op == "$ne":
        if v is None:
            return c.isNotNull()
        return c.isNull() | (c != _lit(v, dtype))
    if op in ("$gt", "$gte", "$lt", "$lte"):
        lv = _lit(v, dtype)
        return {"$gt": c > lv, "$gte": c >= lv, "$lt": c < lv, "$lte": c <= lv}[op]
    if op == "$in":
        vals = [x for x in v if x is not None]
        if elem is not None:
            cond = F.arrays_overlap(c, F.array(*[_lit(x, elem) for x in vals])) if vals else F.lit(False)
        else:
            cond = c.isin([_lit(x, dtype) for x in vals]) if vals else F.lit(False)
        return (cond | c.isNull()) if None in v else cond
    if op == "$nin":
        return ~F.coalesce(_compare(field, "$in", v, dtype), F.lit(False))
    if op == "$exists":
        return c.isNotNull() if v else c.isNull()
    if op == "$regex":
        return c.rlike(v)
    if op == "$size":
        return F.size(c) == F.lit(int(v))
    if op == "$all":
        return F.size(F.array_except(F.array(*[_lit(x, elem) for x in v]), c)) == 0
    raise ValueError(f"unsupported query operator: {op}")


def query_to_column(query: dict | None, schema: T.StructType | None = None,
                    resolve=None) -> Column:
    """a query document -> boolean Column (AND of its entries).

    ``resolve(path) -> Column`` maps a field path to a column (default
    ``F.col``); array filters use it to address a lambda element.
    """
    if not query:
        return F.lit(True)
    resolve = resolve or F.col
    parts: list[Column] = []
    for key, v in query.items():
        if key in ("$and", "$or", "$nor"):
            subs = [query_to_column(q, schema, resolve) for q in v]
            if key == "$and":
                parts.append(reduce(lambda a, b: a & b, subs))
            elif key == "$or":
                parts.append(reduce(lambda a, b: a | b, subs))
            else:
                parts.append(~F.coalesce(reduce(lambda a, b: a | b, subs), F.lit(False)))
            continue
        dtype = _field_type(schema, key)
        if isinstance(v, dict) and v and all(k.startswith("$") for k in v):
            for op, arg in v.items():
                if op == "$not":
                    parts.append(~F.coalesce(query_to_column({key: arg}, schema, resolve), F.lit(False)))
                else:
                    parts.append(_compare(resolve(key), op, arg, dtype))
        elif isinstance(v, dict):
            # nested document given as a sub-query on its fields
            parts.append(query_to_column({f"{key}.{k}": x for k, x in v.items()}, schema, resolve))
        else:
            parts.append(_compare(resolve(key), "$eq", v, dtype))
    return reduce(lambda a, b: a & b, parts)


_COND = re.compile(r"^\s*([A-Za-z_][\w.]*)\s*(>=|<=|!=|=|>|<)\s*(.*?)\s*$")
_OPS = {">=": "$gte", "<=": "$lte", ">": "$gt", "<": "$lt", "=": "$eq", "!=": "$ne"}


def conditions_to_query(conditions: list[str] | str) -> dict:
    """'field<op>value' texts, all of which hold; a repeat of a field and operator goes
    under ``$and``."""
    query: dict = {}
    for text in [conditions] if isinstance(conditions, str) else conditions:
        m = _COND.match(text)
        if not m:
            raise ValueError(f"bad condition: {text!r}")
        field, op, value = m[1], _OPS[m[2]], m[3]
        if op in query.get(field, {}):
            query.setdefault("$and", []).append({field: {op: value}})
        else:
            query.setdefault(field, {})[op] = value
    return query


def conditions_to_column(conditions: list[str] | str, schema: T.StructType) -> Column:
    """condition texts typed by the table schema -> Column."""
    def typed(query: dict) -> dict:
        out = {}
        for field, ops in query.items():
            if field == "$and":
                out[field] = [typed(q) for q in ops]
                continue
            dtype = _field_type(schema, field)
            if dtype is None:
                raise ValueError(f"unknown field in condition: {field}")
            out[field] = {op: _typed_text(v, dtype) for op, v in ops.items()}
        return out

    return query_to_column(typed(conditions_to_query(conditions)), schema)


def _typed_text(v: str, dtype: T.DataType):
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return parse_request_date_literal(v)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return int(v)
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return float(v)
    if isinstance(dtype, T.BooleanType):
        return v.lower() in ("1", "true", "yes")
    return v


def time_range(col: str, start=None, end=None, inclusive: bool = True) -> Column:
    """between start and end (inclusive), or strictly inside (playback)."""
    c = F.col(col)
    cond = F.lit(True)
    if start is not None:
        cond = cond & ((c >= F.lit(start)) if inclusive else (c > F.lit(start)))
    if end is not None:
        cond = cond & ((c <= F.lit(end)) if inclusive else (c < F.lit(end)))
    return cond
