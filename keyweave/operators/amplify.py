"""Items from a key file: partition key by SQL, sort keys over a date range, ordered attributes.

All of it is projection plus one ``explode``: items stream out of the key-file scan, or out of equal shares of the fan-out that are dealt
out before it (``dealt_steps``), which exchanges keys, never items. SQL text in the description may use ``as_of``, the moment the job counts from.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyweave.functions.generators import as_timestamp
from keyweave.functions.nested import json_text

AS_OF = "as_of"
PK, SK, EXTRA = "PK", "SK", "ADDITIONAL_PK"
KEY_COLUMNS = [PK, SK]
#: Items that a task makes at most, and below which it isn't worth a task of its own.
ROWS_PER_TASK, LEAST_ROWS = 1_000_000, 10_000


def partition_keys(keys: DataFrame, spec: Mapping, as_of=None) -> DataFrame:
    """Key file with the item's PK and the carried ADDITIONAL_PK (text ``NA`` if not described)."""
    if AS_OF in keys.columns:
        raise ValueError(f"the key file already has a column {AS_OF}")
    extra = spec.get("ADDITIONAL_SQL")
    return keys.withColumn(AS_OF, as_timestamp(as_of)).withColumns({
        PK: F.expr(spec["SQL"]), EXTRA: F.lit("NA") if extra is None else F.expr(extra)})


def _interval(sk: Mapping) -> int:
    days = int(sk["interval_in_days"])
    if days < 1:
        raise ValueError(f"interval_in_days must be at least 1, got {days}")
    return days


def sort_keys(keys: DataFrame, spec: Mapping) -> DataFrame:
    """One row per key (type ``conf``) or one per step of a closed date range."""
    sk = spec["SK"]
    if sk["type"] == "conf":
        return keys.withColumn(SK, F.expr(sk["val"]))
    days = _interval(sk)
    steps = F.expr(f"explode(sequence(to_timestamp({sk['start']}), to_timestamp({sk['end']}), interval {days} day))")
    return keys.select("*", steps.alias(SK)).withColumn(SK, F.date_format(SK, sk["format"].strip("'")))


def distinct_keys(keys: DataFrame, spec: Mapping) -> DataFrame:
    """Keys that differ in what items are made of: de-duplicates before the fan-out, not after."""
    sk = spec["SK"]
    wanted = [F.col(PK), F.col(EXTRA), F.col(AS_OF)]
    if sk["type"] == "conf":
        return keys.withColumn(SK, F.expr(sk["val"])).select(*wanted, F.col(SK)).distinct()
    first, last = F.expr(f"to_timestamp({sk['start']})"), F.expr(f"to_timestamp({sk['end']})")
    return keys.select(*wanted, first.alias("first"), last.alias("last")).distinct()


def step_time(first: Column, step: Column, days: int) -> Column:
    """The moment ``step`` steps of some days after ``first``, by the calendar of the session's zone."""
    none = F.lit(0)
    return first + F.make_interval(none, none, none, (step * days).cast("int"))


def step_count(first: Column, last: Column, days: int) -> Column:
    """Steps of a closed range: the size of ``sequence(first, last, interval days day)`` without making it. None where a bound is null; a range
    that ends before it starts is an error, as it is there."""
    whole = F.floor(F.datediff(last, first) / days)
    steps = F.when(step_time(first, whole, days) > last, whole).otherwise(whole + 1)
    wrong = F.raise_error(F.concat(F.lit("a range ends before it starts: "), first.cast("string"), F.lit(" .. "), last.cast("string")))
    return F.coalesce(F.when(last < first, wrong.cast("bigint")).otherwise(steps.cast("bigint")), F.lit(0).cast("bigint"))


def tasks_for(rows: int, at_once: int, rows_per_task: int) -> int:
    """Number of tasks: at most ``rows_per_task`` rows each, and of few rows one task for each of ``at_once`` that has ``LEAST_ROWS`` to do."""
    return max(1, -(-rows // rows_per_task), min(at_once, -(-rows // LEAST_ROWS)))


def dealt_steps(ranges: DataFrame, days: int, tasks: int, rows: int) -> DataFrame:
    """Stretches of steps, dealt out so that every task makes the same number of rows however long the ranges are.

    ``ranges`` has columns first, last, steps and times (how often its row is there), and is otherwise distinct. All rows to be made are numbered by a running sum of
    the ranges' lengths: within buckets by hash of the row, and over the buckets' totals, of which there are as many as tasks. A task's share is a
    stretch of these numbers, so a long range is cut and short ones go together. Adds ``low`` and ``high``, numbers of a range's own rows; row ``i`` of
    a range is its step ``i % steps``. Everything follows from the rows' values: a task that runs again makes the same rows.
    """
    share = -(-rows // tasks)
    names = ranges.columns
    sized = ranges.withColumn("kw_size", F.col("steps") * F.col("times")).withColumn("kw_bucket", F.pmod(F.xxhash64(*names), F.lit(tasks)))
    totals = sized.groupBy("kw_bucket").agg(F.sum("kw_size").alias("kw_total"))
    before = totals.select("kw_bucket", (F.sum("kw_total").over(Window.orderBy("kw_bucket")) - F.col("kw_total")).alias("kw_before"))
    own = Window.partitionBy("kw_bucket").orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = sized.withColumn("kw_own", F.sum("kw_size").over(own) - F.col("kw_size")).join(before, "kw_bucket").withColumn("kw_begin", F.col("kw_before") + F.col("kw_own"))
    task = lambda at: F.expr(f"{at} div {share}").cast("int")
    cut = begun.select("*", F.explode(F.sequence(task("kw_begin"), task("(kw_begin + kw_size - 1)"))).alias("kw_task"))
    first = F.col("kw_task").cast("bigint") * share
    low = F.greatest(first, F.col("kw_begin")) - F.col("kw_begin")
    high = F.least(first + share, F.col("kw_begin") + F.col("kw_size")) - F.col("kw_begin") - 1
    return cut.withColumns({"low": low, "high": high}).repartitionById(tasks, F.col("kw_task")).select(*names, "low", "high")


def _balanced(keyed: DataFrame, spec: Mapping, distinct: bool, rows_per_task: int) -> DataFrame:
    """``sort_keys`` of a date range, with the fan-out dealt out by rows."""
    sk = spec["SK"]
    days = _interval(sk)
    bounds = {"first": F.expr(f"to_timestamp({sk['start']})"), "last": F.expr(f"to_timestamp({sk['end']})")}
    names = [PK, EXTRA, AS_OF, *bounds]
    counted = keyed.withColumns(bounds).groupBy(*names).agg((F.lit(1) if distinct else F.count(F.lit(1))).cast("bigint").alias("times"))
    ranges = counted.withColumn("steps", step_count(F.col("first"), F.col("last"), days)).where("steps > 0")
    rows = int(ranges.agg(F.sum(F.col("steps") * F.col("times"))).first()[0] or 0)
    tasks = tasks_for(rows, keyed.sparkSession.sparkContext.defaultParallelism, rows_per_task)
    dealt = dealt_steps(ranges, days, tasks, max(rows, 1))
    made = dealt.select(*names, "steps", F.explode(F.sequence("low", "high")).alias("kw_row"))
    return made.withColumn(SK, F.date_format(step_time(F.col("first"), F.col("kw_row") % F.col("steps"), days), sk["format"].strip("'")))


def keyed_rows(keys: DataFrame, spec: Mapping, as_of=None, distinct: bool = False, rows_per_task: int | None = None) -> DataFrame:
    """PK, SK, ADDITIONAL_PK (and ``as_of``), before attributes. With ``rows_per_task`` the fan-out is counted first and dealt out, so that tasks make equal
    numbers of items; without, each split of the key file makes its own, which needs no exchange."""
    dealt = rows_per_task is not None and spec["SK"]["type"] != "conf"
    if dealt and as_of is None:  # counted and made at the same moment
        as_of = F.lit(keys.sparkSession.sql("SELECT current_timestamp()").first()[0])
    keyed = partition_keys(keys, spec, as_of)
    if dealt:
        return _balanced(keyed, spec, distinct, rows_per_task).select(PK, SK, EXTRA, AS_OF)
    if distinct:
        keyed = distinct_keys(keyed, spec)
        range_spec = {**spec["SK"], "start": "first", "end": "last", "val": SK}
        spec = {**spec, "SK": range_spec}
    return sort_keys(keyed, spec).select(PK, SK, EXTRA, AS_OF)


def json_template(text: str, replacements: Mapping[str, str]) -> Column:
    """JSON text of a constant document with every matching key set from the row, at any depth.

    The document is known when the query is planned, so it becomes a ``concat`` of its fixed pieces
    and the replaced values; no JSON is parsed per row.
    """
    pieces: list[str | Column] = []

    def put(node) -> None:
        if isinstance(node, dict):
            pieces.append("{")
            for i, (key, child) in enumerate(node.items()):
                pieces.append((", " if i else "") + json.dumps(key) + ": ")
                if key in replacements:
                    pieces.append(json_text(F.expr(replacements[key])))
                else:
                    put(child)
            pieces.append("}")
        elif isinstance(node, list):
            pieces.append("[")
            for i, child in enumerate(node):
                pieces.append(", " if i else "")
                put(child)
            pieces.append("]")
        else:
            pieces.append(json.dumps(node))

    put(json.loads(text))
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])


def attribute(props: Mapping) -> Column:
    """Value of one attribute from its description."""
    kind = props["type"]
    if kind == "json":
        return json_template(props["jsonstr"], props["replacement_map"])
    if kind == "audit_date":
        return F.date_format(F.to_date(F.expr(props["val"]), props["format"]), props["format"])
    if kind == "relative_date":
        base = F.to_date(F.col(props["base_date_column"]), props["base_date_format"])
        # midnight UTC, whatever the session's zone
        return F.unix_date(F.date_add(base, int(props["delta_days"]))).cast("bigint") * 86400
    if kind == "string":
        return F.lit(props["str"])
    if kind == "sql":
        return F.expr(props["attr_SQL"])
    raise ValueError(f"unknown attribute type {kind!r}")


def add_attributes(rows: DataFrame, spec: Mapping) -> DataFrame:
    """Attributes in their listed order; each one sees the ones before it."""
    return reduce(lambda df, name: df.withColumn(name, attribute(spec[name])), spec.get("Attrs") or [], rows)


def amplify(keys: DataFrame, spec: Mapping, *, as_of=None, distinct: bool = False, rows_per_task: int | None = None) -> DataFrame:
    """Items of one family. ``distinct`` drops repeated keys before the fan-out; for ``rows_per_task`` see ``keyed_rows``."""
    return add_attributes(keyed_rows(keys, spec, as_of, distinct, rows_per_task), spec).drop(AS_OF)


def fan_out_of_keys(keys: DataFrame, spec: Mapping, *, as_of=None, distinct: bool = False) -> DataFrame:
    """Number of items per partition key, counted on the keys without making the items."""
    keyed = partition_keys(keys, spec, as_of)
    if distinct:
        keyed = distinct_keys(keyed, spec)
    sk = spec["SK"]
    n = F.lit(1)
    if sk["type"] != "conf":
        first, last = ("first", "last") if distinct else (f"to_timestamp({sk['start']})", f"to_timestamp({sk['end']})")
        n = step_count(F.expr(first), F.expr(last), _interval(sk))
    return keyed.groupBy(PK).agg(F.sum(n.cast("bigint")).alias("n_items"))


def amplify_families(keys: DataFrame, config: Mapping, *, as_of=None, distinct: bool = False,
                     rows_per_task: int | None = None) -> dict[str, DataFrame]:
    """One item frame per listed family."""
    return {name: amplify(keys, config["PKdesc"][name], as_of=as_of, distinct=distinct, rows_per_task=rows_per_task)
            for name in config["PKlst"]}


def union_families(families: Mapping[str, DataFrame]) -> DataFrame:
    """All families in one frame; attributes a family lacks are null."""
    tagged = [df.withColumn("family", F.lit(name)) for name, df in families.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def item_columns(items: DataFrame) -> DataFrame:
    """What is stored: the item without its carrier column."""
    return items.drop(EXTRA)


def put_items(stored: DataFrame, batch: DataFrame, order_by: str, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """Stored items after a put: an item of the batch replaces the whole stored item of its key.

    Of several writes of one key the one with the highest ``order_by`` wins, a null is lowest, and at a tie the greatest JSON text of the row,
    so the result doesn't depend on how rows are dealt out. Attributes may be of any type; those one side lacks are null.
    """
    both = item_columns(stored).withColumn("kw_side", F.lit(0)).unionByName(
        item_columns(batch).withColumn("kw_side", F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys]
    rank = F.struct("kw_side", F.col(order_by), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}))
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("kw_best"))
    return best.select(*[F.col(c) if c in keys else F.col("kw_best")[c].alias(c) for c in both.columns if c != "kw_side"])
