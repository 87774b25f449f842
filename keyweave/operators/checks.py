"""Integrity checks: each returns the offending keys, an empty frame when the promise holds.

Both sides are reduced to one row per key by partial aggregation before the exchange, so a key that
holds a third of the rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fingerprints (8 bytes each) that are sent to all tasks at most.
FEW_REPEATED = 100_000


def _names(columns: str | list[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def foreign_key_violations(child: DataFrame, child_key, parent: DataFrame, parent_key) -> DataFrame:
    """Child key values without a parent, with their number of rows; nulls refer to nothing."""
    ck, pk = _names(child_key), _names(parent_key)
    wanted = child.dropna(subset=ck).groupBy(*ck).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(ck, pk, strict=True)]).distinct()
    return wanted.join(known, ck, "left_anti")


def _fingerprint(names: list[str]) -> Column:
    return F.xxhash64(*[F.col(n) for n in names])


def repeated_fingerprints(df: DataFrame, names: list[str]) -> DataFrame:
    """Fingerprints of 64 bits that more than one row has: all keys that repeat are among their keys."""
    counted = df.select(_fingerprint(names).alias("kw_print")).groupBy("kw_print").agg(F.count(F.lit(1)).alias("kw_rows"))
    return counted.where("kw_rows > 1").select("kw_print")


def primary_key_violations(df: DataFrame, key, few: int = FEW_REPEATED) -> DataFrame:
    """Key values that are null or held by several rows, with their number of rows.

    In two levels: fingerprints of the keys are counted first, and keys themselves only of rows whose fingerprint repeats, so that of a table
    whose keys hold, 16 bytes a row are exchanged however wide the key is. That is worth it while few fingerprints repeat: up to ``few``
    of them are sent to all tasks, beyond that all keys are counted. The result is exact either way, and a key that holds a third of
    the rows is one row a task in both levels.
    """
    names = _names(key)
    null = _any([F.col(n).isNull() for n in names])
    repeated = [r[0] for r in repeated_fingerprints(df, names).limit(few + 1).collect()]
    rows = df.select(*names)
    if len(repeated) <= few:
        known = df.sparkSession.createDataFrame([(x,) for x in repeated], "kw_print long")
        marked = rows.withColumns({"kw_print": _fingerprint(names), "kw_null": null})
        rows = marked.join(F.broadcast(known.withColumn("kw_known", F.lit(True))), "kw_print", "left").where(F.col("kw_known").isNotNull() | F.col("kw_null"))
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | _any([F.col(n).isNull() for n in names]))


def dependency_violations(df: DataFrame, key, dependent) -> DataFrame:
    """Key values that come with more than one value of the dependent columns; as in a count of distinct values, rows
    where one of these is null don't count."""
    names, rest = _names(key), _names(dependent)
    pairs = df.select(*names, *rest).dropna(subset=rest).distinct()
    return (pairs.groupBy(*names).agg(F.count(F.lit(1)).alias("n_values"))
            .where(F.col("n_values") > 1))


def item_key_violations(items: DataFrame) -> DataFrame:
    """Item keys that are not unique: a put would overwrite."""
    return primary_key_violations(items, ["PK", "SK"])


def fan_out(items: DataFrame) -> DataFrame:
    """Number of items per partition key."""
    return items.groupBy("PK").agg(F.count(F.lit(1)).alias("n_items"))
