"""Validation by model rules.

A model is data: for each field its type and rules. The rules compile to one column, the array of reasons for
which a record is refused, so a whole batch is checked in one pass and every reason is told. Values that
arrive as text are converted as their type asks; a value that can't be converted is a reason, never a
silent null.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewell.functions.predicates import object_id_col
from framewell.functions.timefmt import parse_request_date


@dataclass(frozen=True)
class Rule:
    """What a field's value must be. ``type`` is a Spark type name, ``object_id`` (24 hex digits) or ``datetime`` (one of
    the request date formats, or a timestamp)."""

    type: str
    required: bool = False
    least: float | None = None
    most: float | None = None
    choices: tuple | None = None
    pattern: str | None = None
    max_length: int | None = None
    default: object = None


def model_from_json(text: str) -> dict[str, Rule]:
    """U4: a model from its JSON text ({field: {type, required, ...}}); a field may also be given as its type alone."""
    out = {}
    for name, rule in json.loads(text).items():
        rule = {"type": rule} if isinstance(rule, str) else dict(rule)
        if "choices" in rule:
            rule["choices"] = tuple(rule["choices"])
        out[name] = Rule(**rule)
    return out


def load_model(spark: SparkSession, path: str) -> dict[str, Rule]:
    """U4: a model from a JSON file on any file system that Spark reads (the file is read on the driver: a model
    is one small document)."""
    return model_from_json(spark.read.text(path, wholetext=True).first()[0])


def model_from_schema(schema: T.StructType, required: Sequence[str] = ()) -> dict[str, Rule]:
    """Rules that ask for a schema's types; fields that aren't nullable are required, and those named."""
    return {f.name: Rule(f.dataType.simpleString(), required=f.name in required or not f.nullable) for f in schema.fields}


def _converted(name: str, rule: Rule, df: DataFrame) -> Column:
    """The field in its type; null where it can't be converted. A missing field is null."""
    if name not in df.columns:
        value = F.lit(None).cast("string")
    else:
        value = F.col(f"`{name}`")
    kind = df.schema[name].dataType if name in df.columns else T.StringType()
    if rule.type == "object_id":
        return F.when(object_id_col(value.cast("string")), F.lower(value.cast("string")))
    if rule.type == "datetime":
        return parse_request_date(value) if isinstance(kind, T.StringType) else value.try_cast("timestamp")
    return value.try_cast(rule.type)


def checked(df: DataFrame, model: Mapping[str, Rule], strict: bool = False) -> DataFrame:
    """The model's fields in their types (defaults in place of nulls), the other columns as they are, and ``reasons``, the
    sorted array of what is wrong with each record (empty: accepted). ``strict`` refuses records that give a value for a
    field the model doesn't know."""
    reasons, fields = [], []
    for name, rule in model.items():
        raw = F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")
        value = _converted(name, rule, df)
        known = raw.isNotNull() & value.isNotNull()
        if rule.required and rule.default is None:
            reasons.append(F.when(raw.isNull(), F.lit(f"{name}: required")))
        reasons.append(F.when(raw.isNotNull() & value.isNull(), F.lit(f"{name}: not {rule.type}")))
        if rule.least is not None:
            reasons.append(F.when(known & (value < F.lit(rule.least)), F.lit(f"{name}: less than {rule.least}")))
        if rule.most is not None:
            reasons.append(F.when(known & (value > F.lit(rule.most)), F.lit(f"{name}: more than {rule.most}")))
        if rule.choices is not None:
            reasons.append(F.when(known & ~value.isin(*rule.choices), F.lit(f"{name}: not a choice")))
        if rule.pattern is not None:
            reasons.append(F.when(known & ~value.cast("string").rlike(rule.pattern), F.lit(f"{name}: malformed")))
        if rule.max_length is not None:
            reasons.append(F.when(known & (F.length(value.cast("string")) > rule.max_length), F.lit(f"{name}: longer than {rule.max_length}")))
        fields.append((F.coalesce(value, F.lit(rule.default)) if rule.default is not None else value).alias(name))
    others = [c for c in df.columns if c not in model and c != "reasons"]
    if strict:
        reasons += [F.when(F.col(f"`{c}`").isNotNull(), F.lit(f"{c}: unknown")) for c in others]
    # the reasons come out of a generator: filters on them don't compute every rule again
    packed = F.struct(*fields, F.array_sort(F.array_compact(F.array(*reasons))).cast("array<string>").alias("reasons"))
    return df.select(*[F.col(f"`{c}`") for c in others], F.inline(F.array(packed)))


@dataclass
class Inserted:
    """Outcome of an insert: the table with the accepted records, their ids, the refused records with their
    reasons, and a one-row frame of counts."""

    table: DataFrame
    ids: DataFrame
    rejects: DataFrame
    counts: DataFrame


def insert_validated(target: DataFrame, docs: DataFrame, model: Mapping[str, Rule], key: str = "_id", order: str | None = None,
                     strict: bool = False) -> Inserted:
    """M1/M2: records that pass the model are appended to ``target``, the others are returned with every reason; nothing
    becomes a silent null.

    A record without a key gets an object id; one whose key is stored already, or that an earlier record of the batch
    has (by ``order``, else any but one), is refused, as a store with a unique key does. ``docs`` should be a written table
    if it isn't repeatable: generated ids are drawn once per evaluation, so write ``ids`` and ``table`` from one persisted
    frame (``rejects`` and ``counts`` don't depend on them).
    """
    rows = checked(docs, model, strict)
    has_key = F.col(key).isNotNull()
    # the keys of a batch, each with the record that comes first; one row per key and task crosses the shuffle
    rank = F.col(order) if order else F.monotonically_increasing_id()
    numbered = rows.withColumn("_rank", rank)
    good = numbered.where((F.size("reasons") == 0) & has_key)
    first = good.groupBy(key).agg(F.min("_rank").alias("_first"))
    stored = target.select(F.col(key).alias(f"{key}")).where(has_key).distinct().withColumn("_stored", F.lit(True))
    seen = first.join(stored, key, "left")
    judged = numbered.join(seen, key, "left").withColumn("reasons", F.when((F.size("reasons") == 0) & has_key, F.array_compact(F.array(
        F.when(F.coalesce("_stored", F.lit(False)), F.lit(f"{key}: stored already"))
        .when(F.col("_rank") > F.col("_first"), F.lit(f"{key}: repeated"))))).otherwise(F.col("reasons")))
    judged = judged.drop("_stored", "_first", *([] if order == "_rank" else ["_rank"]))
    accepted = judged.where(F.size("reasons") == 0).drop("reasons")
    new_id = F.substring(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), 1, 24)
    accepted = accepted.withColumn(key, F.coalesce(F.col(key), new_id.cast(accepted.schema[key].dataType)))
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in accepted.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in target.schema.fields]
    ids = accepted.select(*([order] if order else []), F.col(key))
    counts = judged.agg(F.count_if(F.size("reasons") == 0).alias("inserted_count"), F.count_if(F.size("reasons") > 0).alias("rejected_count"))
    return Inserted(target.unionByName(accepted.select(*columns)), ids, judged.where(F.size("reasons") > 0), counts)
