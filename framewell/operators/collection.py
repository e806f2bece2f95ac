"""Read side of the document collection.

A request (query document, projection name, sort list, page) becomes one
DataFrame plan; Catalyst pushes the filter and the projection into the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewell.functions.codec import py_str, py_type_name
from framewell.functions.predicates import (coerce_query, conditions_to_column,
                                            query_to_column)
from framewell.operators import ordering
from framewell.operators.parse import project_model
from framewell.operators.versions import document


def find(df: DataFrame, query: dict | None = None, coerce: bool = True) -> DataFrame:
    """rows matching a query document (T6 coercion first)."""
    q = coerce_query(query) if coerce else query
    return df.filter(query_to_column(q, df.schema))


def find_expr(df: DataFrame, conditions: Sequence[str] | str) -> DataFrame:
    """rows matching 'field<op>value' texts, AND-ed, typed by schema."""
    return df.filter(conditions_to_column(conditions, df.schema))


def find_with_paginate(df: DataFrame, query: dict | None = None, project: str | None = None,
                       sort: Sequence[str] | None = None, page_size: int | None = None,
                       page_num: int | None = None, key: str = "_id", keep_total: bool = False) -> DataFrame:
    """F1 + P3 + O1 + O2 + A2 in one plan.

    The page carries ``total_count`` (all matches) as a scalar subquery, so
    the count and the page come from one lazy DataFrame. With ``keep_total`` a page past the end is one
    row that has nothing but the total (its key is null).
    """
    matched = find(df, query)
    total = matched.select(F.count(F.lit(1))).scalar()
    page = ordering.paginate(matched, sort, page_size, page_num, tie_break=key)
    out = project_model(page, project).withColumn("total_count", total)
    if not keep_total:
        return out
    shown = page.select(F.count(F.lit(1))).scalar()
    bare = df.sparkSession.range(1).where(shown == 0).select(total.alias("total_count"))
    return out.unionByName(bare, allowMissingColumns=True)


def total_count(df: DataFrame, query: dict | None = None) -> DataFrame:
    """A2: one-row count of the matches."""
    return find(df, query).agg(F.count(F.lit(1)).alias("total_count"))


def find_by_id(df: DataFrame, ids: DataFrame, key: str = "_id", id_col: str = "requested_id",
               miss_code: int = 400) -> DataFrame:
    """F6 for many ids at once: each requested id with its document or a miss.

    A miss is reported (``miss_code`` and a message), never raised.
    """
    req = ids.select(F.col(id_col)).distinct()
    docs = df.withColumn("_found", F.lit(True))
    out = req.join(docs, req[id_col] == docs[key], "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    return (out.withColumn("code", F.when(found, F.lit(200)).otherwise(F.lit(miss_code)))
               .withColumn("message", F.when(~found, F.concat(F.lit("doc is not found, doc_id : "),
                                                              F.col(id_col).cast("string"))))
               .drop("_found"))


def distinct_values(df: DataFrame, fields: Sequence[str], query: dict | None = None) -> DataFrame:
    """Distinct values of each field as (field, value text, type name).

    One scan: each row emits one struct per field, then a distributed
    distinct (partial aggregation map-side). The filter is not coerced, as
    in a tag query of the list page. Null values are treated as missing.
    """
    src = df.filter(query_to_column(query, df.schema)) if query else df
    items = [F.struct(F.lit(f).alias("field"), py_str(F.col(f), df.schema[f].dataType).alias("value"),
                      F.lit(py_type_name(df.schema[f].dataType)).alias("type")) for f in fields]
    return (src.select(F.explode(F.array(*items)).alias("_e")).select("_e.*")
               .filter(F.col("value").isNotNull()).distinct())


# --- aggregation stages (A5) ---------------------------------------------------

def _expr(e) -> Column:
    """Stage expression: '$field', literal, or {$op: [args]}."""
    if isinstance(e, str) and e.startswith("$"):
        return F.col(e[1:])
    if isinstance(e, dict) and len(e) == 1:
        (op, args), = e.items()
        args = args if isinstance(args, list) else [args]
        a = [_expr(x) for x in args]
        if op == "$add":
            return reduce(lambda x, y: x + y, a)
        if op == "$subtract":
            return a[0] - a[1]
        if op == "$multiply":
            return reduce(lambda x, y: x * y, a)
        if op == "$divide":
            return a[0] / a[1]
        if op == "$round":
            return F.round(a[0], int(args[1]) if len(args) > 1 else 0)
        if op == "$toString":
            return a[0].cast("string")
        if op == "$toDouble":
            return a[0].cast("double")
        if op == "$toDecimal":
            # exact money arithmetic: decimal(18, scale), default two places
            scale = int(args[1]) if len(args) > 1 else 2
            return a[0].cast(f"decimal(18,{scale})")
        if op == "$concat":
            return F.concat(*a)
        if op == "$year":
            return F.year(a[0])
        if op == "$month":
            return F.month(a[0])
        if op == "$ifNull":
            return F.coalesce(*a)
        if op == "$cond":
            return F.when(a[0], a[1]).otherwise(a[2])
        if op in ("$eq", "$ne", "$gt", "$gte", "$lt", "$lte"):
            x, y = a
            return {"$eq": x == y, "$ne": x != y, "$gt": x > y, "$gte": x >= y,
                    "$lt": x < y, "$lte": x <= y}[op]
        raise ValueError(f"unsupported expression operator: {op}")
    return F.lit(e)


def _accumulator(name: str, spec: dict, sort_keys: list[tuple[str, bool]]) -> Column:
    (op, arg), = spec.items()
    if op == "$sum":
        return F.sum(_expr(arg)).alias(name)
    if op == "$avg":
        return F.avg(_expr(arg)).alias(name)
    if op == "$min":
        return F.min(_expr(arg)).alias(name)
    if op == "$max":
        return F.max(_expr(arg)).alias(name)
    if op == "$count":
        return F.count(F.lit(1)).alias(name)
    if op in ("$first", "$last"):
        if not sort_keys or len({asc for _, asc in sort_keys}) != 1:
            raise ValueError(f"{op} needs a preceding $sort in one direction")
        asc = sort_keys[0][1]
        order = F.struct(*[F.col(k) for k, _ in sort_keys]) if len(sort_keys) > 1 else F.col(sort_keys[0][0])
        pick_min = (op == "$first") == asc
        return (F.min_by if pick_min else F.max_by)(_expr(arg), order).alias(name)
    raise ValueError(f"unsupported accumulator {op}: collecting whole groups into one row is not supported "
                     "($topN and $bottomN collect a bounded number)")


def _directed(spec: dict, turn: bool = False) -> list[Column]:
    """Sort columns of {field: 1 or -1}."""
    return [F.col(k).asc() if (v > 0) != turn else F.col(k).desc() for k, v in spec.items()]


def _top_n(df: DataFrame, keys: list[Column], names: list[str], name: str, op: str, spec: dict) -> DataFrame:
    """(keys, name): the outputs of each group's first (or last) n rows in order. The ranking keeps n rows a group and
    task before the shuffle, so no group is collected whole."""
    n, output = int(spec["n"]), spec["output"]
    ranked = df.select(*keys, *[F.col(k).alias(f"_s{i}") for i, k in enumerate(spec["sortBy"])], _expr(output).alias("_v"))
    order = {f"_s{i}": v for i, v in enumerate(spec["sortBy"].values())}
    w = Window.partitionBy(*names).orderBy(*_directed(order, turn=op == "$bottomN"))
    kept = ranked.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    listed = F.transform(F.sort_array(F.collect_list(F.struct("_r", "_v")), asc=op == "$topN"), lambda x: x["_v"])
    return kept.groupBy(*names).agg(listed.alias(name))


def _group(df: DataFrame, keys: list[Column], names: list[str], accumulators: dict, sort_keys) -> DataFrame:
    """One row per group: plain accumulators in one aggregate, each bounded collection joined to it."""
    lists = {k: v for k, v in accumulators.items() if next(iter(v)) in ("$topN", "$bottomN")}
    aggs = [_accumulator(k, v, sort_keys) for k, v in accumulators.items() if k not in lists]
    if not lists:
        if not keys:
            return df.agg(*aggs)
        return df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    if not keys:
        keys, names = [F.lit(0).alias("_all")], ["_all"]
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    for k, v in lists.items():
        (op, spec), = v.items()
        out = ordering._join_null_safe(out, _top_n(df, keys, names, k, op, spec), names, "left")
    return out.select(*[c for c in names if c != "_all"], *accumulators)


def _lookup(df: DataFrame, spec: dict, collections: Mapping[str, DataFrame]) -> DataFrame:
    """$lookup by equality. With ``unwind`` each match is a row with the other document as struct ``as`` (null without a
    match); else ``as`` is the array of at most ``most`` matches in the order of ``sortBy`` (empty without one), which a
    key of any size can't outgrow."""
    other, name, local = collections[spec["from"]], spec["as"], F.col(spec["localField"])
    doc = other.select(F.col(spec["foreignField"]).alias("_k"), F.struct(*[F.col(c) for c in other.columns]).alias(name),
                       *[F.col(c).alias(f"_s{i}") for i, c in enumerate(spec.get("sortBy", {}))])
    left = df.drop(name)
    if spec.get("unwind"):
        return left.join(doc.select("_k", name), local == F.col("_k"), "left").drop("_k")
    if "most" not in spec or not spec.get("sortBy"):
        raise ValueError("$lookup needs unwind, or most and sortBy: collecting all matches into one row is not supported")
    order = {f"_s{i}": v for i, v in enumerate(spec["sortBy"].values())}
    kept = doc.where(F.col("_k").isNotNull()).withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy(*_directed(order)))).where(F.col("_r") <= int(spec["most"]))
    lists = kept.groupBy("_k").agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", name))), lambda x: x[name]).alias(name))
    joined = left.join(lists, local == F.col("_k"), "left").drop("_k")
    empty = F.array().cast(lists.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(F.col(name), empty))


def _bucket_id(spec: dict) -> Column:
    """The lower boundary of each row's bucket; ``default`` outside all of them, or else null rows that $match can tell."""
    value, bounds = _expr(spec["groupBy"]), spec["boundaries"]
    if list(bounds) != sorted(set(bounds)) or len(bounds) < 2:
        raise ValueError("$bucket boundaries must ascend")
    out = None
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        hit = (value >= F.lit(low)) & (value < F.lit(high))
        out = F.when(hit, F.lit(low).cast("string")) if out is None else out.when(hit, F.lit(low).cast("string"))
    return out.otherwise(F.lit(spec["default"]).cast("string")) if "default" in spec else out.otherwise(
        F.raise_error(F.concat(F.lit("$bucket: no bucket holds "), F.coalesce(value.cast("string"), F.lit("null")))).cast("string"))


def aggregate(df: DataFrame, stages: Sequence[dict], collections: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A5: ordered stage list -> one DataFrame plan.

    Stages: $match, $group, $bucket, $sortByCount, $lookup, $unionWith, $facet, $replaceRoot, $project, $addFields / $set,
    $unset, $sort, $skip, $limit, $unwind, $count. Group ids: '$field' -> column ``_id`` (as text); a document of fields ->
    one column per field. ``collections`` are the frames that $lookup and $unionWith name. $facet gives the rows of every
    facet as (facet, doc as VARIANT). No type coercion of the stages.
    """
    out = df
    collections = collections or {}
    sort_keys: list[tuple[str, bool]] = []
    for stage in stages:
        (op, arg), = stage.items()
        if op == "$match":
            out = out.filter(query_to_column(arg, out.schema))
        elif op == "$group":
            gid = arg["_id"]
            if gid is None:
                keys = []
            elif isinstance(gid, dict):
                keys = [_expr(v).alias(k) for k, v in gid.items()]
            else:
                keys = [_expr(gid).cast("string").alias("_id")]
            names = [] if gid is None else list(gid) if isinstance(gid, dict) else ["_id"]
            out = _group(out, keys, names, {k: v for k, v in arg.items() if k != "_id"}, sort_keys)
            sort_keys = []
        elif op == "$bucket":
            out = _group(out, [_bucket_id(arg).alias("_id")], ["_id"], arg.get("output", {"count": {"$count": {}}}), sort_keys)
            sort_keys = []
        elif op == "$sortByCount":
            out = out.groupBy(_expr(arg).cast("string").alias("_id")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "_id")
            sort_keys = []
        elif op == "$lookup":
            out = _lookup(out, arg, collections)
        elif op == "$unionWith":
            spec = {"coll": arg} if isinstance(arg, str) else arg
            other = aggregate(collections[spec["coll"]], spec.get("pipeline", []), collections)
            out = out.unionByName(other, allowMissingColumns=True)
        elif op == "$facet":
            facets = [aggregate(out, inner, collections) for inner in arg.values()]
            rows = [f.select(F.lit(k).alias("facet"), document(F.struct(*[F.col(c) for c in f.columns])).alias("doc"))
                    for k, f in zip(arg, facets, strict=True)]
            out = reduce(lambda a, b: a.unionAll(b), rows)
        elif op == "$replaceRoot":
            root = _expr(arg["newRoot"]) if not isinstance(arg["newRoot"], dict) else F.struct(*[_expr(v).alias(k) for k, v in arg["newRoot"].items()])
            out = out.select(root.alias("_root")).where(F.col("_root").isNotNull()).select("_root.*")
        elif op == "$unset":
            out = out.drop(*([arg] if isinstance(arg, str) else arg))
        elif op in ("$project", "$addFields", "$set"):
            cols = {} if op == "$project" else {c: F.col(c) for c in out.columns}
            for k, v in arg.items():
                if v in (1, True):
                    cols[k] = F.col(k)
                elif v in (0, False):
                    cols.pop(k, None)
                    if op == "$project" and not cols:
                        cols = {c: F.col(c) for c in out.columns if c != k}
                else:
                    cols[k] = _expr(v)
            out = out.select(*[c.alias(k) for k, c in cols.items()])
        elif op == "$sort":
            sort_keys = [(k, v >= 0) for k, v in arg.items()]
            out = out.orderBy(*[F.col(k).asc() if a else F.col(k).desc() for k, a in sort_keys])
        elif op == "$skip":
            out = out.offset(int(arg))
        elif op == "$limit":
            out = out.limit(int(arg))
        elif op == "$unwind":
            path = arg if isinstance(arg, str) else arg["path"]
            field = path.lstrip("$")
            options = {} if isinstance(arg, str) else arg
            one = (F.posexplode_outer if options.get("preserveNullAndEmptyArrays") else F.posexplode)(F.col(field))
            index = options.get("includeArrayIndex")
            rest = [c for c in out.columns if c not in (field, index)]
            out = out.select(*rest, one.alias("_at", "_one")).select(*rest, F.col("_one").alias(field), *([F.col("_at").cast("long").alias(index)] if index else []))
        elif op == "$count":
            out = out.agg(F.count(F.lit(1)).alias(arg))
        else:
            raise ValueError(f"unsupported stage: {op}")
    return out
