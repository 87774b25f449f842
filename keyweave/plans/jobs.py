"""Whole jobs: tables and key file from a configuration, items from a key file. Both can be run again."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from keyweave.operators import amplify, synthesize
from keyweave.sources import tables


def synthesize_job(spark: SparkSession, config: Mapping, *, rows: int, starting_id: int, database: str, keyfile: str, appname: str, version: str,
                   headers: Mapping[str, str] | None = None, partitions: int | None = None, chained: bool = True, as_of=None) -> bool:
    """Makes every table of the configuration, in its order, and the key file, of ``rows`` seed ids from ``starting_id``. A table's schema is that of the
    catalog, else that of its header file.

    A batch that the key file has already is left as it is (False), one that shares ids with another of its version is an error, and one that was
    cut off is made anew in the place of what it left.
    """
    if tables.is_made(spark, keyfile, version, starting_id, rows):
        return False
    schemas = {t: tables.resolve_schema(spark, f"{database}.{t}", (headers or {}).get(t)) for t in config["table_list"]}
    for name, schema in schemas.items():
        made = synthesize.synth_window(spark, rows, starting_id, schema, config, partitions=partitions, chained=chained, as_of=as_of)
        tables.write_batch(made, f"{database}.{name}", version, starting_id)
    keys = synthesize.build_keyfile(synthesize.seed_ids(spark, rows, starting_id, partitions), schemas, config, appname=appname, version=version,
                                    starting_id=starting_id, chained=chained, as_of=as_of)
    tables.write_keyfile(keys, keyfile)
    return True


def amplify_job(spark: SparkSession, config: Mapping, *, keyfile: str, items: str, below: str = "", as_of=None, distinct: bool = True,
                rows_per_task: int | None = amplify.ROWS_PER_TASK) -> None:
    """Writes the items of every family made from a key file, or the part ``below`` it, as Parquet: a folder for each family in ``items``, in it one
    for each part, which a rerun replaces."""
    keys = tables.scan_keyfile(spark, keyfile, below)
    part = below.strip("/").replace("/", ",").replace("=", "-") or "all"
    for name, rows in amplify.amplify_families(keys, config, as_of=as_of, distinct=distinct, rows_per_task=rows_per_task).items():
        amplify.item_columns(rows).write.mode("overwrite").parquet(f"{items.rstrip('/')}/{name}/part={part}")
