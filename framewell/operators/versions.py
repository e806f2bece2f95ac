"""Change records from two versions of a keyed table.

A document is a row; a null field is a missing one. Every document that differs between the versions
gives one record with its whole document and before-image as VARIANT, whatever its fields: a change feed
for a table that has none of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.timefmt import JSON_TIME_PATTERN


def document(row: Column) -> Column:
    """A row as a VARIANT document without its null fields; times keep their microseconds."""
    return F.parse_json(F.to_json(row, {"timestampFormat": JSON_TIME_PATTERN, "timestampNTZFormat": JSON_TIME_PATTERN}))


def _leaves(path: str, old: Column, new: Column, kind: T.DataType, both: Column) -> Iterator[tuple[str, Column, Column, T.DataType]]:
    """(path, old, new, type) of what an update names: a field, or the fields of a nested document that both versions
    have. Where a leaf doesn't apply both its sides are null."""
    if not isinstance(kind, T.StructType):
        yield path, F.when(both, old), F.when(both, new), kind
        return
    nested = both & old.isNotNull() & new.isNotNull()
    yield path, F.when(both & ~nested, old), F.when(both & ~nested, new), T.NullType()
    for f in kind.fields:
        yield from _leaves(f"{path}.{f.name}", old[f.name], new[f.name], f.dataType, nested)


def diff_versions(old: DataFrame, new: DataFrame, key: str = "_id", collection: str = "images", db: str = "db",
                  replaced: Column | None = None) -> DataFrame:
    """Change records (ns, documentKey, operationType, updateDescription, fullDocumentBeforeChange,
    fullDocument) that turn version ``old`` into ``new``: insert, update, replace or delete.

    One full outer join on the key (unique in each version; rows without a key are no documents). An
    update names the new values of changed fields (dotted paths in nested documents), the fields that are
    gone, and arrays cut to a shorter one; equal documents give no record. A replace is a change of all
    fields, or where ``replaced`` says so (a condition on the new row). A column that one version lacks is
    missing in all its documents.
    """
    names = [f.name for f in new.schema.fields if f.name != key] + [f.name for f in old.schema.fields if f.name != key and f.name not in new.columns]
    kinds = {**{f.name: f.dataType for f in old.schema.fields}, **{f.name: f.dataType for f in new.schema.fields}}

    def side(df: DataFrame, name: str) -> DataFrame:
        fields = [F.col(f"`{c}`").cast(kinds[c]) if c in df.columns else F.lit(None).cast(kinds[c]) for c in [key, *names]]
        flag = [replaced.alias("_replaced")] if replaced is not None and name == "_new" else []
        return df.where(F.col(f"`{key}`").isNotNull()).select(
            F.col(f"`{key}`").alias(f"{name}_key"), F.struct(*[x.alias(c) for x, c in zip(fields, [key, *names], strict=True)]).alias(name), *flag)

    j = side(old, "_old").join(side(new, "_new"), F.col("_old_key") == F.col("_new_key"), "full_outer")
    both = F.col("_old_key").isNotNull() & F.col("_new_key").isNotNull()
    o, n = F.col("_old"), F.col("_new")
    leaves = [x for c in names for x in _leaves(c, o[c], n[c], kinds[c], both)]
    cut = {p: (F.size(b) < F.size(a)) & F.slice(a, F.lit(1), F.size(b)).eqNullSafe(b) for p, a, b, k in leaves if isinstance(k, T.ArrayType)}
    off = {p: F.coalesce(x, F.lit(False)) for p, x in cut.items()}
    changed = {p: ~a.eqNullSafe(b) for p, a, b, _ in leaves}
    updated = F.struct(*[F.when(changed[p] & ~off.get(p, F.lit(False)), b).alias(p) for p, _, b, _ in leaves])
    removed = F.array_compact(F.array(*[F.when(changed[p] & b.isNull(), F.lit(p)) for p, _, b, _ in leaves])).cast("array<string>")
    truncated = F.array_compact(F.array(*[F.when(off[p], F.struct(F.lit(p).alias("field"), F.size(b).alias("newSize")))
                                          for p, _, b, _ in leaves if p in off])).cast("array<struct<field:string,newSize:int>>")
    anything = reduce(lambda a, b: a | b, changed.values(), F.lit(False))
    everything = reduce(lambda a, b: a & b, [~o[c].eqNullSafe(n[c]) for c in names], F.lit(bool(names)))
    operation = (F.when(F.col("_old_key").isNull(), "insert").when(F.col("_new_key").isNull(), "delete")
                 .when(~anything, F.lit(None)).when(F.coalesce(F.col("_replaced"), F.lit(False)) if replaced is not None else everything, "replace")
                 .otherwise("update"))
    rows = j.withColumn("operationType", operation).where(F.col("operationType").isNotNull())
    return rows.select(
        F.struct(F.lit(db).alias("db"), F.lit(collection).alias("coll")).alias("ns"),
        F.struct(F.coalesce("_new_key", "_old_key").cast("string").alias("_id")).alias("documentKey"),
        "operationType",
        F.when(F.col("operationType") == "update", F.struct(
            document(updated).alias("updatedFields"), removed.alias("removedFields"), truncated.alias("truncatedArrays"))).alias("updateDescription"),
        F.when(F.col("_old_key").isNotNull(), document(o)).alias("fullDocumentBeforeChange"),
        F.when(F.col("_new_key").isNotNull(), document(n)).alias("fullDocument"))


def apply_changes(old: DataFrame, changes: DataFrame, key: str = "_id") -> DataFrame:
    """The version that ``changes`` (one record a document) lead to: the inverse of ``diff_versions``. Documents are
    read in the schema of ``old``."""
    last = changes.select(F.col("documentKey._id").alias("_key"), "operationType", "fullDocument")
    kept = old.join(last.select("_key"), F.col(key).cast("string") == F.col("_key"), "left_anti")
    fields = [F.try_variant_get("fullDocument", f"$['{f.name}']", f.dataType.simpleString()).cast(f.dataType).alias(f.name) for f in old.schema.fields]
    return kept.unionByName(last.where("operationType != 'delete'").select(*fields))
