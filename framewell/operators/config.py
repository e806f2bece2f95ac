"""Nested documents -> (key, value, type) entries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Variant type name -> Python type name of the value.
_TYPE_NAMES = [("BIGINT", "int"), ("INT", "int"), ("SMALLINT", "int"), ("TINYINT", "int"),
               ("DOUBLE", "float"), ("FLOAT", "float"), ("DECIMAL", "float"), ("STRING", "str"),
               ("BOOLEAN", "bool"), ("ARRAY", "list"), ("OBJECT", "dict"), ("NULL", "NoneType"),
               ("TIMESTAMP", "datetime"), ("DATE", "date")]


def _type_name(schema_col):
    out = F.lit(None).cast("string")
    for prefix, name in reversed(_TYPE_NAMES):
        out = F.when(schema_col.startswith(prefix), F.lit(name)).otherwise(out)
    return out


def flatten_config(df: DataFrame, json_col: str, keep: list[str]) -> DataFrame:
    """JSON objects -> one row per leaf with a dotted key path.

    Parsed once to VARIANT, then one chain of generators: each level
    explodes the values that are objects (``variant_explode_outer``) and
    passes the others through unchanged, so the document is read and parsed
    once whatever the depth. The number of levels comes from the data: one aggregate
    over the deepest run of open braces. A malformed document gives one row with a
    null key, its text and type 'malformed'.
    """
    spark = df.sparkSession
    # a bound of the nesting: braces are counted outside quoted text
    plain = F.regexp_replace(F.col(json_col), r'"(?:[^"\\\\]|\\\\.)*+"', "")
    braces = F.filter(F.split(F.regexp_replace(plain, r"[^{}]", ""), ""), lambda x: x != "")
    deepest = F.aggregate(braces, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda s, x: F.struct(
        (s["now"] + F.when(x == "{", 1).otherwise(-1)).alias("now"),
        F.greatest(s["most"], s["now"] + F.when(x == "{", 1).otherwise(-1)).alias("most")))["most"]
    depth = df.select(F.max(deepest)).first()[0] or 1
    cols = ", ".join(f"t.`{c}`" for c in keep)
    level = spark.sql(
        f"SELECT {cols}, v.key AS key, v.value AS value FROM {{src}} t, "
        f"LATERAL variant_explode(try_parse_json(t.`{json_col}`)) v", src=df)
    for _ in range(depth - 1):
        level = spark.sql(
            f"SELECT {cols}, CASE WHEN v.key IS NULL THEN t.key ELSE t.key || '.' || v.key END AS key, "
            f"CASE WHEN v.key IS NULL THEN t.value ELSE v.value END AS value FROM {{src}} t, "
            f"LATERAL variant_explode_outer(CASE WHEN schema_of_variant(t.value) LIKE 'OBJECT%' "
            f"THEN t.value END) v", src=level)
    kind = F.expr("schema_of_variant(value)")
    text = F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.expr("to_json(value)")) \
        .otherwise(F.expr("variant_get(value, '$', 'string')"))
    good = level.select(*keep, "key", text.alias("value"), _type_name(kind).alias("type"))
    bad = df.where(F.col(json_col).isNotNull() & F.try_parse_json(json_col).isNull()).select(
        *keep, F.lit(None).cast("string").alias("key"), F.col(json_col).alias("value"), F.lit("malformed").alias("type"))
    return good.unionByName(bad)
