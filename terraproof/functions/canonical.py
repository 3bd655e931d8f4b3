"""Canonical JSON and digests: the same whatever the order of fields, map entries and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def in_name_order(value: Column, kind: DataType) -> Column:
    """``value`` with the fields of its structs in order of name and the entries of its maps in order of key, at every depth."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(in_name_order(value.getField(f.name), f.dataType).alias(f.name) for f in fields)))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: in_name_order(x, kind.elementType)) if _has_names(kind.elementType) else value
    if isinstance(kind, MapType):
        keys = F.array_sort(F.map_keys(value))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: in_name_order(F.element_at(value, k), kind.valueType)))
    return value


def _has_names(kind: DataType) -> bool:
    return isinstance(kind, (StructType, MapType)) or (isinstance(kind, ArrayType) and _has_names(kind.elementType))


def canonical_json(df: DataFrame, *columns: str, keep_nulls: bool = False) -> Column:
    """JSON of some columns of ``df`` (all if none is named), in order of name; fields that are null are left out unless kept."""
    chosen = StructType([df.schema[c] for c in (columns or df.columns)])
    fields = (in_name_order(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in sorted(chosen.fields, key=lambda f: f.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false" if keep_nulls else "true"})


def canonical_key(df: DataFrame, namespace: str, *columns: str) -> Column:
    """Address of a result: namespace and digest of the namespace and the columns' canonical JSON."""
    return F.concat(F.lit(namespace + "-"), F.sha2(F.concat(F.lit(namespace), F.lit("\u0000"), canonical_json(df, *columns)), 256))


def rows_digest(df: DataFrame, *by: str, columns: tuple[str, ...] = ()) -> DataFrame:
    """(by, n, digest) of rows, whatever their order; copies count.

    Digests of equal rows are counted first, then sorted and digested by their first four digits, and these are digested
    again; so no task gets a list of all rows.
    """
    h = F.sha2(canonical_json(df, *columns, keep_nulls=True), 256)
    each = df.select(*by, h.alias("h")).groupBy(*by, "h").agg(F.count(F.lit(1)).alias("c"))
    part = each.groupBy(*by, F.substring("h", 1, 4).alias("at")).agg(F.sum("c").alias("c"), F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "h", F.col("c").cast("string")))), ","), 256).alias("d"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "d"))), lambda x: x["d"]), ",")
    total = part.groupBy(*by) if by else part.groupBy()
    return total.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.sha2(F.coalesce(whole, F.lit("")), 256).alias("digest"))
