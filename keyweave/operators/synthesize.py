"""Tables and key file from base and key column definitions.

Every column is an expression over the seed id, so a table of any size is one scan of the ids. The
only shuffle is the whole-row ``distinct`` of a table, and it runs on the few small integers that
decide the row: ranges wrap, so partial aggregation shrinks each task's share to at most the number
of different rows before anything is exchanged, also when one value holds most of the ids.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyweave.functions import generators as g

SEED = "id"
RANGED, DATE_RANGE, DELTA_DAYS, COLUMN_DELTA = "ranged", "dateRange", "deltaDays", "columnBasedDeltaDays"
WORD, TEXT, CONST_DATE, SQL = "word", "text", "confdate", "confval"


def kind_of(name: str, props: Mapping) -> str:
    """Generator named by a column definition; unknown names are an error."""
    datatype = props.get("datatype")
    if datatype == "date":
        if props.get("genType") in (DATE_RANGE, DELTA_DAYS, COLUMN_DELTA):
            return props["genType"]
        raise ValueError(f"column {name}: unknown genType {props.get('genType')!r}")
    if datatype == "faker":
        return TEXT if props.get("options") is None else WORD
    if datatype in (CONST_DATE, SQL):
        return datatype
    if datatype in (None, "int", "integer", "long"):
        return RANGED
    raise ValueError(f"column {name}: unknown datatype {datatype!r}")


class Definitions:
    """Resolved column definitions of one configuration.

    ``chained`` honours the base column of a base column, so an employee's department fixes the
    cost centre. ``chained=False`` drives every base column from the seed id alone.
    """

    def __init__(self, config: Mapping, *, chained: bool = True, as_of=None):
        self.base = dict(config.get("basemap") or {})
        self.keys = dict(config.get("keymap") or {})
        self.chained = chained
        self.moment = g.as_timestamp(as_of)
        for name, props in self.base.items():
            self._need_range(name, props)
        for name, props in self.keys.items():
            if kind_of(name, props) == RANGED:
                self._need_range(name, props)

    @staticmethod
    def _need_range(name: str, props: Mapping) -> None:
        if props.get("minVal") is None or props.get("maxVal") is None:
            raise ValueError(f"column {name}: minVal and maxVal are needed")
        try:
            g.range_size(props["minVal"], props["maxVal"], props.get("step", 1))
        except ValueError as error:
            raise ValueError(f"column {name}: {error}") from error

    def _props(self, name: str) -> Mapping:
        if name in self.base:
            return self.base[name]
        if name in self.keys:
            return self.keys[name]
        raise ValueError(f"unknown base column {name!r}")

    def _source(self, name: str) -> str:
        """Column that drives ``name``; the seed id unless another one is named."""
        props = self._props(name)
        if name in self.base and not self.chained:
            return SEED
        source = props.get("baseCol") or SEED
        return source["val"] if isinstance(source, Mapping) else source

    def _driver(self, name: str, seen: tuple) -> Column:
        """Integer that drives the range column ``name``."""
        if name in seen:
            raise ValueError(f"columns depend on each other: {' > '.join(seen + (name,))}")
        source = self._source(name)
        if source == SEED:
            driver = F.col(SEED)
        elif self.is_ranged(source):
            driver = self.number(source, seen + (name,))
        else:
            driver = g.hash_number(self.value(source))
        return g.hash_number(driver) if self._props(name).get("baseColType") == "hash" else driver

    def is_ranged(self, name: str) -> bool:
        return name in self.base or kind_of(name, self._props(name)) == RANGED

    def number(self, name: str, seen: tuple = ()) -> Column:
        """Integer value of a range column, before any prefix."""
        p = self._props(name)
        return g.ranged(self._driver(name, seen), p["minVal"], p["maxVal"], p.get("step", 1))

    def period(self, name: str) -> tuple[int | None, bool]:
        """After how many consecutive seed ids the column's deciding value repeats (None: not known), and whether it is another one for each
        of these ids."""
        if not self.varies(name):
            return 1, True
        p = self._props(name)
        kind = RANGED if self.is_ranged(name) else kind_of(name, p)
        if kind == SQL:
            return None, False
        source, hashed = self._source(name), p.get("baseColType") == "hash"
        size = None
        if kind == RANGED:
            size = g.range_size(p["minVal"], p["maxVal"], p.get("step", 1))
        elif kind == DATE_RANGE:
            size = g.day_count(p["minVal"], p["maxVal"])
        if source == SEED:
            return (size, True) if size is not None and not hashed else (None, False)
        period, single = self.period(source)
        if size is None or hashed or not self.is_ranged(source) or period is None:
            return period, False
        # consecutive values of the source stay apart while a whole turn of their steps fits into the range
        above = self._props(source)
        values = g.range_size(above["minVal"], above["maxVal"], above.get("step", 1))
        return period, single and values <= size // math.gcd(int(above.get("step", 1)), size)

    def varies(self, name: str) -> bool:
        """False when all rows get the same value."""
        return name in self.base or kind_of(name, self.keys[name]) not in (DELTA_DAYS, CONST_DATE)

    def derived_from(self, name: str) -> str | None:
        """Other column whose finished value alone decides this one, if any."""
        if name in self.base or kind_of(name, self.keys[name]) not in (WORD, TEXT, COLUMN_DELTA):
            return None
        return self._source(name)

    def deciding(self, name: str) -> Column:
        """Smallest value that decides the column: what ``distinct`` needs to look at."""
        p = self._props(name)
        if self.is_ranged(name):
            return g.range_position(self._driver(name, ()), p["minVal"], p["maxVal"], p.get("step", 1))
        kind = kind_of(name, p)
        if kind == DATE_RANGE:
            days = g.day_count(p["minVal"], p["maxVal"])
            return F.pmod(self._driver(name, ()), F.lit(days).cast("bigint"))
        if kind == WORD:
            return g.first_equal_option(g.pick_position(self.value(self._source(name)), len(p["options"])), p["options"])
        return self.finished(name, None)

    def finished(self, name: str, decided: Column | None, source: Column | None = None) -> Column:
        """Cell value from the deciding value; columns with a source column read that instead."""
        p = self._props(name)
        if self.is_ranged(name):
            return g.prefixed(g.range_at(decided, p["minVal"], p.get("step", 1)), p.get("prefix"))
        kind = kind_of(name, p)
        if kind == DATE_RANGE:
            return g.day_at(decided, p["minVal"])
        if kind == DELTA_DAYS:
            return g.days_from(self.moment, p["deltaDays"])
        if kind == CONST_DATE:
            return g.constant_day(p["val"])
        if kind == SQL:
            return F.expr(str(p["val"]))
        if kind == WORD and decided is not None:
            return g.option_at(decided, p["options"])
        base = self.value(self._source(name)) if source is None else source
        if kind == WORD:
            return g.pick(base, p["options"])
        if kind == TEXT:
            return g.fake_text(p["fakerText"], base, name)
        return g.days_after_text(base, p["deltaDays"])

    def value(self, name: str) -> Column:
        """Cell value straight from the seed id."""
        if name == SEED:
            return F.col(SEED)
        if not self.is_ranged(name) and kind_of(name, self._props(name)) != DATE_RANGE:
            return self.finished(name, None)
        return self.finished(name, self.deciding(name))

    def frame(self, seeds: DataFrame, seed: str = SEED) -> DataFrame:
        """Seed ids with all base and range columns; unused ones are pruned by the optimizer."""
        ranged = [n for n in self.keys if n not in self.base and kind_of(n, self.keys[n]) == RANGED]
        return seeds.select(F.col(seed).cast("bigint").alias(SEED)).select(
            SEED, *[self.value(n).alias(n) for n in [*self.base, *ranged]])


def seed_ids(spark: SparkSession, rows: int, start: int = 0, partitions: int | None = None) -> DataFrame:
    """``rows`` consecutive ids from ``start``; later batches continue where this one ends."""
    return spark.range(start, start + rows, 1, partitions)


def _typed(value: Column, field: T.StructField, props: Mapping | None) -> Column:
    if props and props.get("prefix") is not None and not isinstance(field.dataType, T.StringType):
        raise ValueError(f"column {field.name}: prefix {props['prefix']!r} needs a text column, "
                         f"the schema says {field.dataType.simpleString()}")
    if isinstance(field.dataType, T.DateType):
        return F.to_date(value, g.DAY_TEXT)
    return value.cast(field.dataType)


def as_schema(schema) -> T.StructType:
    """StructType from itself or from DDL text."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def synth_rows(seeds: DataFrame, schema, config: Mapping, *, seed: str = SEED, chained: bool = True,
               as_of=None) -> DataFrame:
    """One row per seed id for a table, before de-duplication."""
    defs = Definitions(config, chained=chained, as_of=as_of)
    cells = [_typed(defs.value(f.name) if f.name in defs.keys else F.lit(None), f, defs.keys.get(f.name))
             .alias(f.name) for f in as_schema(schema).fields]
    return defs.frame(seeds, seed).select(*cells)


def synth_table(seeds: DataFrame, schema, config: Mapping, *, seed: str = SEED, chained: bool = True,
                as_of=None, apart: bool = False) -> DataFrame:
    """Distinct rows of a table: columns without a definition are null. ``apart`` says that the seeds are known to give different rows.

    Same result as ``synth_rows(...).distinct()``. Constants, nulls and columns that follow from
    another column of the table are filled in after the shuffle. Where the column's type can make different
    values equal, the typed value itself is what ``distinct`` looks at.
    """
    defs = Definitions(config, chained=chained, as_of=as_of)
    fields = {f.name: f for f in as_schema(schema).fields}
    varying = [n for n in fields if n in defs.keys and defs.varies(n)]
    merged = {n for n in varying if _may_merge(defs, n, fields[n])}
    sources = {n: defs.derived_from(n) for n in varying if n not in merged}
    later = {n: s for n, s in sources.items() if s in varying and s not in merged and defs.derived_from(s) is None}
    first = [n for n in varying if n not in later]
    deciding = [(_typed(defs.value(n), fields[n], defs.keys[n]) if n in merged else defs.deciding(n)).alias(n) for n in first]
    rows = defs.frame(seeds, seed).select(*(deciding or [F.lit(1).alias(SEED)]))
    rows = rows if apart else rows.distinct()
    plain = {n: defs.finished(n, F.col(n)) if _has_position(defs, n) else F.col(n) for n in first if n not in merged}
    cells = []
    for name, field in fields.items():
        if name in merged:
            cells.append(F.col(name))
            continue
        if name not in defs.keys:
            value = F.lit(None)
        elif name in later:
            value = defs.finished(name, None, plain[later[name]])
        else:
            value = plain[name] if name in plain else defs.finished(name, None)
        cells.append(_typed(value, field, defs.keys.get(name)).alias(name))
    return rows.select(*cells)


def _has_position(defs: Definitions, name: str) -> bool:
    return defs.is_ranged(name) or kind_of(name, defs.keys[name]) in (DATE_RANGE, WORD)


def _may_merge(defs: Definitions, name: str, field: T.StructField) -> bool:
    """Whether the column's type can make different generated values equal."""
    if isinstance(field.dataType, T.StringType):
        return False
    if defs.is_ranged(name):
        return not isinstance(field.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    return not (kind_of(name, defs.keys[name]) in (DATE_RANGE, COLUMN_DELTA) and isinstance(field.dataType, T.DateType))


def build_keyfile(seeds: DataFrame, schemas: Mapping, config: Mapping, *, appname: str, version: str,
                  starting_id: int, seed: str = SEED, chained: bool = True, as_of=None) -> DataFrame:
    """One wide row per seed id with the keys of all tables and audit columns; no shuffle.

    Range columns keep their name and appear once; all others are named ``{table}_{column}``.
    """
    defs = Definitions(config, chained=chained, as_of=as_of)
    cells = {n: defs.value(n) for n in defs.base}
    for table in config["table_list"]:
        wanted = {f.name for f in as_schema(schemas[table]).fields}
        for name in defs.keys:
            if name in wanted:
                cells[name if defs.is_ranged(name) else f"{table}_{name}"] = defs.value(name)
    cells |= {"appname": F.lit(appname), "version": F.lit(str(version)),
              "startingId": F.lit(int(starting_id)).cast("bigint"),
              "dt": F.date_format(defs.moment, g.DAY_TEXT)}
    return defs.frame(seeds, seed).select(*[c.alias(n) for n, c in cells.items()])


def synth_all(seeds: DataFrame, schemas: Mapping, config: Mapping, *, seed: str = SEED, chained: bool = True,
              as_of=None) -> dict[str, DataFrame]:
    """All tables in insertion order (parents first)."""
    return {t: synth_table(seeds, schemas[t], config, seed=seed, chained=chained, as_of=as_of)
            for t in config["table_list"]}


def window_of(rows: int, schema, config: Mapping, *, chained: bool = True) -> tuple[int, bool]:
    """Of ``rows`` consecutive seed ids, how many at the beginning give all different rows of a table, and whether each of these gives
    another row.

    A row repeats after the least common multiple of its columns' periods. Within it rows differ as long as the columns that have another value
    for each id of their own period do so together, which is up to the least common multiple of theirs.
    """
    defs = Definitions(config, chained=chained)
    fields = {f.name: f for f in as_schema(schema).fields}
    varying = [n for n in fields if n in defs.keys and defs.varies(n)]
    periods = {n: defs.period(n) for n in varying}
    if all(p is not None for p, _ in periods.values()):
        rows = min(rows, math.lcm(*[p for p, _ in periods.values()]))
    apart = math.lcm(*[p for n, (p, single) in periods.items() if single and not _may_merge(defs, n, fields[n])])
    return rows, rows <= apart


def synth_window(spark: SparkSession, rows: int, start: int, schema, config: Mapping, *, partitions: int | None = None, chained: bool = True,
                 as_of=None) -> DataFrame:
    """``synth_table`` of consecutive seed ids: makes only the ids that can give a new row, and has no exchange where each of them does."""
    first, apart = window_of(rows, schema, config, chained=chained)
    return synth_table(seed_ids(spark, first, start, partitions), schema, config, chained=chained, as_of=as_of, apart=apart)


def synth_batches(spark: SparkSession, rows: int, starts: list[int], schema, config: Mapping, *,
                  partitions: int | None = None, chained: bool = True, as_of=None) -> list[DataFrame]:
    """One table frame per batch of seed ids; batches must not overlap."""
    ordered = sorted(starts)
    if any(b - a < rows for a, b in zip(ordered, ordered[1:])):
        raise ValueError(f"batches of {rows} ids starting at {ordered} overlap")
    return [synth_window(spark, rows, s, schema, config, partitions=partitions, chained=chained, as_of=as_of) for s in starts]
