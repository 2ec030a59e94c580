"""Nested partial updates.

A patch is a JSON object with the fields to change. A field that is absent keeps its
value, one that is null becomes null, a nested object changes its own fields only
(starting from an empty struct where there was none), an array is replaced whole, and
unknown fields are ignored. All of it is a column expression over the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def patched(current: Column, kind: T.DataType, patch: Column) -> Column:
    """``current``, a struct of type ``kind``, with the JSON object ``patch``. A
    value that is not an object leaves the struct as it is."""
    present = F.json_object_keys(patch)
    given = F.from_json(patch, kind)
    fields = []
    for f in kind.fields:
        old = current[f.name]
        new = given[f.name]
        if isinstance(f.dataType, T.StructType):
            inner = F.get_json_object(patch, f"$.{f.name}")
            # get_json_object gives NULL for a JSON null
            new = F.when(inner.isNull(), F.lit(None).cast(f.dataType)).otherwise(patched(old, f.dataType, inner))
        fields.append(F.when(F.array_contains(present, f.name), new).otherwise(old).alias(f.name))
    return F.when(present.isNull(), current).otherwise(F.struct(*fields))


def partial_update(rows: DataFrame, patches: DataFrame, key: str, column: str, patch: str = "patch") -> DataFrame:
    """``rows`` with the struct ``column`` patched where ``patches`` (key, patch) has
    a row for the key; keys of patches are unique."""
    p = patches.select(F.col(key).alias("__k"), F.col(patch).alias("__patch"))
    joined = rows.join(p, rows[key] == p["__k"], "left")
    new = F.when(F.col("__patch").isNull(), F.col(column)).otherwise(patched(F.col(column), rows.schema[column].dataType, F.col("__patch")))
    return joined.withColumn(column, new).drop("__k", "__patch")
