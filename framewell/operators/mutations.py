"""Table mutations as set operations.

Each call returns the new table as a DataFrame; a boolean ``_modified`` (or an
integer ``_modified_count``) column carries what a store would count, so the
count is one aggregate over the result. Writers persist the new version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.predicates import coerce_query, query_to_column
from framewell.operators.ordering import keep_last, keep_last_values


# --- literals typed by the target column ----------------------------------------

def _typed(v, dtype: T.DataType) -> Column:
    if isinstance(v, Column):
        return v.cast(dtype)
    if isinstance(dtype, T.StructType) and v is not None:
        return F.struct(*[_typed(v.get(f.name), f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        if v is None:
            return F.lit(None).cast(dtype)
        return F.array(*[_typed(x, dtype.elementType) for x in v]).cast(dtype)
    return F.lit(v).cast(dtype)


def _field_type(schema: T.StructType, path: Sequence[str]) -> T.DataType:
    dtype: T.DataType = schema
    for p in path:
        dtype = dtype[p].dataType  # type: ignore[index]
    return dtype


def _document(v) -> Column:
    """A literal; dictionaries become structs."""
    if isinstance(v, dict):
        return F.struct(*[_document(x).alias(k) for k, x in v.items()])
    return v if isinstance(v, Column) else F.lit(v)


def _set_path(col: Column, schema: T.DataType, path: list[str], value_fn, create: Column | None = None) -> Column:
    """Replace the value at ``path`` inside ``col`` by ``value_fn(old)``; where ``create`` holds, parents
    that are null become documents first."""
    if not path:
        return value_fn(col)
    if create is not None:
        col = F.when(col.isNull() & create, _typed({}, schema)).otherwise(col)
    head, rest = path[0], path[1:]
    sub = col.getField(head)
    sub_type = schema[head].dataType  # type: ignore[index]
    return col.withField(head, _set_path(sub, sub_type, rest, value_fn, create))


def _element_filter(x: Column, spec: dict, var: str, elem_type: T.DataType) -> Column:
    q = {k[len(var) + 1:]: v for k, v in spec.items() if k.startswith(var + ".")}
    schema = elem_type if isinstance(elem_type, T.StructType) else None

    def resolve(path: str) -> Column:
        out = x
        for p in path.split("."):
            out = out.getField(p)
        return out
    return F.coalesce(query_to_column(q, schema, resolve), F.lit(False))


def _apply_ops(df: DataFrame, match: Column, set_: dict | None, unset: dict | None,
               push: dict | None, array_filter: dict | None) -> tuple[DataFrame, list[str]]:
    """Apply $set/$unset/$push under ``match``; return the frame and touched top fields."""
    schema = df.schema
    new: dict[str, Column] = {c: F.col(c) for c in df.columns}
    touched: list[str] = []
    absent: dict = {}  # values below top fields that the table lacks

    def touch(top: str):
        if top not in touched:
            touched.append(top)

    for path, v in (set_ or {}).items():
        parts = path.split(".")
        if "$[" in path:
            # array element update: 'arr.$[e].field' with filter {'e.x': ...}
            i = next(j for j, p in enumerate(parts) if p.startswith("$["))
            var = parts[i][2:-1]
            arr_path, elem_path = parts[:i], parts[i + 1:]
            arr_type = _field_type(schema, arr_path)
            elem_type = arr_type.elementType  # type: ignore[attr-defined]
            spec = array_filter or {}

            def upd(arr, elem_type=elem_type, elem_path=elem_path, var=var, spec=spec, v=v):
                def one(x):
                    val = _set_path(x, elem_type, elem_path, lambda old: _typed(v, _field_type(elem_type, elem_path)) if elem_path else _typed(v, elem_type))
                    return F.when(match & _element_filter(x, spec, var, elem_type), val).otherwise(x)
                return F.transform(arr, one)
            top = arr_path[0]
            new[top] = _set_path(new[top], schema[top].dataType, arr_path[1:], upd)
            touch(top)
            continue
        top = parts[0]
        if top not in new:
            spot = absent
            for p in parts[:-1]:
                spot = spot.setdefault(p, {})
            spot[parts[-1]] = v
            continue
        dtype = _field_type(schema, parts)
        new[top] = _set_path(new[top], schema[top].dataType, parts[1:],
                             lambda old, dtype=dtype, v=v: F.when(match, _typed(v, dtype)).otherwise(old), match)
        touch(top)
    for top, v in absent.items():
        new[top] = F.when(match, _document(v))
        touch(top)
    for path in (unset or {}):
        parts = path.split(".")
        top = parts[0]
        if top not in new:
            continue
        dtype = _field_type(schema, parts)
        new[top] = _set_path(new[top], schema[top].dataType, parts[1:],
                             lambda old, dtype=dtype: F.when(match, F.lit(None).cast(dtype)).otherwise(old))
        touch(top)
    for path, v in (push or {}).items():
        parts = path.split(".")
        top = parts[0]
        if top not in new and len(parts) == 1:
            # missing array: created with the one pushed element on matched rows
            new[top] = F.when(match, F.array(v if isinstance(v, Column) else F.lit(v)))
            touch(top)
            continue
        arr_type = _field_type(schema, parts)
        elem = _typed(v, arr_type.elementType)  # type: ignore[attr-defined]

        def app(old, arr_type=arr_type, elem=elem):
            grown = F.array_append(F.coalesce(old, F.array().cast(arr_type)), elem)
            return F.when(match, grown).otherwise(old)
        new[top] = _set_path(new[top], schema[top].dataType, parts[1:], app, match)
        touch(top)
    return df.select(*[c.alias(k) for k, c in new.items()]), touched


def _changed(touched: list[str], existing: set[str]) -> Column:
    """Any touched field differs from its old value (a new field always does)."""
    if not touched:
        return F.lit(False)
    if any(c not in existing for c in touched):
        return F.lit(True)
    return ~F.struct(*[F.col(f"_old_{c}") for c in touched]).eqNullSafe(
        F.struct(*[F.col(c) for c in touched]))


def update(df: DataFrame, query: dict | None, set: dict | None = None,  # noqa: A002
           unset: dict | None = None, push: dict | None = None, array_filter: dict | None = None,
           upsert: bool = False, one: bool = False, key: str = "_id",
           coerce: bool = True) -> DataFrame:
    """M3/M5-M9: apply one update request; adds ``_modified`` (bool).

    ``one`` restricts the match to the first matching key (M3); with
    ``upsert`` a document built from the query's equality fields, to which the
    request is applied, is added when nothing matched (M9); without a key of its own it gets
    a random one, which needs a text key.
    """
    q = coerce_query(query or {}) if coerce else (query or {})
    set_ = coerce_query(set) if (coerce and set) else set
    match = F.coalesce(query_to_column(q, df.schema), F.lit(False))
    if one:
        picked = df.filter(match).select(F.min(key)).scalar()
        match = F.coalesce(F.col(key) == picked, F.lit(False))
    tops = {p.split(".")[0] for ops in (set_, unset, push) for p in (ops or {})}
    # old values only for the fields the request touches
    base = df.select("*", match.alias("_match"),
                     *[F.col(c).alias(f"_old_{c}") for c in df.columns if c in tops])
    applied, touched = _apply_ops(base, F.col("_match"), set_, unset, push, array_filter)
    added = [c for c in applied.columns if c not in base.columns]
    out = applied.select(*df.columns, *added,
                         (F.col("_match") & _changed(touched, {*df.columns})).alias("_modified"))
    if upsert:
        eq = {k: v for k, v in q.items() if not k.startswith("$") and not isinstance(v, dict)}
        if key in df.columns and key not in eq and key not in (set_ or {}) and not isinstance(df.schema[key].dataType, T.StringType):
            raise ValueError(f"an upsert needs a value of {key!r}")
        blank = df.sparkSession.range(1).select(*[_typed(eq.get(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
        below = {k: v for k, v in eq.items() if "." in k}
        doc, _ = _apply_ops(blank, F.lit(True), {**below, **(set_ or {})}, unset, push, array_filter)
        if key in df.columns and key not in eq and key not in (set_ or {}):
            doc = doc.withColumn(key, F.expr("uuid()"))
        none_matched = df.filter(match).select(F.count(F.lit(1))).scalar() == 0
        new_doc = doc.withColumn("_modified", F.lit(False)).filter(none_matched)
        out = out.unionByName(new_doc)
    return out


def update_many(df: DataFrame, requests: Sequence[dict], key: str = "_id") -> DataFrame:
    """M4: requests applied in order; ``_modified_count`` counts per row how
    many requests changed it (a row changed twice counts twice; upserts do
    not count). Requests without an update are skipped. Unordered mode has
    the same result here: one set-based plan, no partial failure."""
    out = df.withColumn("_modified_count", F.lit(0))
    for r in requests:
        if not any(r.get(k) for k in ("set", "unset", "push")):
            continue
        step = update(out.withColumnRenamed("_modified_count", "_mc_keep"),
                      r.get("query"), r.get("set"), r.get("unset"), r.get("push"),
                      r.get("array_filter"), r.get("upsert", False), key=key)
        out = step.withColumn("_modified_count", F.coalesce(F.col("_mc_keep"), F.lit(0))
                              + F.col("_modified").cast("int")).drop("_mc_keep", "_modified")
    return out


def update_by_key(df: DataFrame, requests: DataFrame, key: str, order: str | Sequence[str],
                  fields: Sequence[str]) -> DataFrame:
    """M4 for many keyed $set requests: one request table, joined on the key.

    Per key and field the last request that supplies the field (by ``order``) wins; a
    null request value leaves the field as it is. One shuffle join; no per-request plan.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    last = keep_last_values(requests.select(key, *dict.fromkeys([*order_cols, *fields])), key, order_cols)
    req = last.select(key, *[F.col(f).alias(f"_new_{f}") for f in fields],
                      F.lit(True).alias("_req"))
    j = df.join(req, key, "left")
    cols = []
    changed = F.lit(False)
    for c in df.columns:
        if c in fields:
            new = F.coalesce(F.col(f"_new_{c}"), F.col(c))
            changed = changed | ~new.eqNullSafe(F.col(c))
            cols.append(new.alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols, (F.coalesce(F.col("_req"), F.lit(False)) & changed).alias("_modified"))


def delete_many(df: DataFrame, query: dict | None, coerce: bool = True) -> DataFrame:
    """Drop every match; a predicate that is null keeps the row."""
    q = coerce_query(query or {}) if coerce else (query or {})
    return df.filter(~F.coalesce(query_to_column(q, df.schema), F.lit(False)))


def deleted_count(df: DataFrame, query: dict | None) -> DataFrame:
    """A6 for deletes: one-row count of the rows a delete would remove."""
    q = coerce_query(query or {})
    return df.filter(F.coalesce(query_to_column(q, df.schema), F.lit(False))).agg(
        F.count(F.lit(1)).alias("deleted_count"))


def delete_one(df: DataFrame, query: dict | None, key: str = "_id") -> DataFrame:
    """Drop the first match (smallest key)."""
    q = coerce_query(query or {})
    picked = df.filter(F.coalesce(query_to_column(q, df.schema), F.lit(False))).select(F.min(key)).scalar()
    return df.filter(~(picked.isNotNull() & F.col(key).eqNullSafe(picked)))


def insert_many(target: DataFrame, docs: DataFrame, key: str | None = None) -> DataFrame:
    """Bag union by column name; missing fields become null.

    Docs are cast to the target types with ``try_cast`` (bad values -> null;
    validate first with C1 to reject instead). Without a key, a random id is
    generated for each new document.
    """
    cols = []
    for f in target.schema.fields:
        if f.name in docs.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        elif key is not None and f.name == key:
            cols.append(F.expr("uuid()").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return target.unionByName(docs.select(*cols))


def merge_by_key(target: DataFrame, batch: DataFrame, key: str = "name",
                 order: str | Sequence[str] = "event_id", drop: Sequence[str] = (),
                 guard: bool = False, partial: bool = False, arrival: Sequence[str] | None = None) -> DataFrame:
    """``update_one({key: k}, {'$set': doc}, upsert=True)`` for a batch.

    Last arrival wins inside the batch (W1); batch fields overwrite, fields
    only the target has survive, unknown keys are inserted. One full outer
    join on the key. With ``guard`` a stored row is replaced only by a batch
    row whose ``order`` is not smaller (replay- and reorder-safe). ``arrival``
    names the columns (batch, partition, offset) kept with every row: offsets are then
    compared within a topic partition only, and between partitions the later batch wins. With
    ``partial`` records may carry a subset of the fields: null means "not
    supplied", so within the batch each field keeps its last supplied value
    and a stored value survives where the batch supplies none.
    """
    b = keep_last_values(batch, key, order) if partial else keep_last(batch, key, order)
    b = b.drop(*drop)
    b_cols = [c for c in b.columns if c != key]
    t_cols = [c for c in target.columns if c != key]
    bj = b.select(key, *[F.col(c).alias(f"_b_{c}") for c in b_cols], F.lit(True).alias("_in_b"))
    j = target.join(bj, key, "full_outer")
    hit = F.coalesce(F.col("_in_b"), F.lit(False))
    if arrival:
        run, part, off = arrival
        same = F.col(part) == F.col(f"_b_{part}")
        later = F.when(same, F.col(f"_b_{off}") >= F.col(off)).otherwise(F.col(f"_b_{run}") >= F.col(run))
        hit = hit & F.coalesce(later, F.lit(True))  # a row without an order, or a new one
    elif guard:
        ocols = [order] if isinstance(order, str) else list(order)
        if all(c in t_cols and c in b_cols for c in ocols):
            t_o = F.struct(*[F.col(c) for c in ocols])
            b_o = F.struct(*[F.col(f"_b_{c}") for c in ocols])
            hit = hit & (F.col(ocols[0]).isNull() | (b_o >= t_o))
    cols = [F.col(key)]
    for c in t_cols:
        if c not in b_cols:
            cols.append(F.col(c))
            continue
        new = F.coalesce(F.col(f"_b_{c}"), F.col(c)) if partial else F.col(f"_b_{c}")
        cols.append(F.when(hit, new).otherwise(F.col(c)).alias(c))
    for c in b_cols:
        if c not in t_cols:
            cols.append(F.col(f"_b_{c}").alias(c))
    return j.select(*cols)


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Column defaults for missing or null values."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in out.columns else F.lit(v))
    return out


# Fixed value: e-mail shape accepted by the user schema (local@domain.tld).
EMAIL_PATTERN = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+$"


def check_constraints(df: DataFrame, key: str = "id", unique: Sequence[str] = ("email",),
                      not_null: Sequence[str] = ("name", "email", "hashed_password"),
                      email: str | None = "email") -> DataFrame:
    """C4: violations as rows (constraint, value, n).

    One scan and one shuffle: a grouping-sets aggregate groups by the key,
    by each unique column, and not at all (for the null counts), with
    map-side combine, so a hot value costs one row per task.
    """
    keycols = [key, *unique]
    never_null = list(dict.fromkeys([key, *not_null]))  # a primary key is never null either
    src = df.select(*[F.col(c).cast("string").alias(f"_k_{c}") for c in keycols],
                    *[F.col(c).isNull().alias(f"_null_{c}") for c in never_null],
                    (F.col(email).isNotNull() & ~F.col(email).rlike(EMAIL_PATTERN)).alias("_bad")
                    if email else F.lit(False).alias("_bad"))
    sets = [[f"_k_{c}"] for c in keycols] + [[]]
    agg = src.groupingSets(sets, *[f"_k_{c}" for c in keycols]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_bad").alias("_n_bad"),
        *[F.count_if(f"_null_{c}").alias(f"_n_null_{c}") for c in never_null],
        F.grouping_id().alias("_gid"))
    width = len(keycols)
    items = []
    for i, c in enumerate(keycols):
        # grouping_id bit is 0 for the grouped column, 1 for the others
        gid = sum(1 << (width - 1 - j) for j in range(width) if j != i)
        col = F.col(f"_k_{c}")
        mine = (F.col("_gid") == gid) & col.isNotNull()
        items.append(F.struct(F.lit(f"duplicate {c}").alias("constraint"), col.alias("value"),
                              F.when(mine & (F.col("n") > 1), F.col("n")).alias("n")))
        if c == email:
            items.append(F.struct(F.lit("bad email").alias("constraint"), col.alias("value"),
                                  F.when(mine & (F.col("_n_bad") > 0), F.col("_n_bad")).alias("n")))
    total = F.col("_gid") == (1 << width) - 1
    for c in never_null:
        items.append(F.struct(F.lit(f"null {c}").alias("constraint"), F.lit(None).cast("string").alias("value"),
                              F.when(total & (F.col(f"_n_null_{c}") > 0), F.col(f"_n_null_{c}")).alias("n")))
    # one pass over the aggregate: each row yields the violations it holds
    return (agg.select(F.explode(F.array(*items)).alias("_v")).select("_v.*")
               .filter(F.col("n").isNotNull()))
