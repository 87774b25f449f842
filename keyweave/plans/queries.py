"""Registered queries over the given tables, and the SQL that tells what each of them must return."""

from __future__ import annotations

from pyspark.sql import functions as F

from keyweave.functions import generators as g
from keyweave.functions import nested
from keyweave.operators import amplify, checks, synthesize
from keyweave.plans.sample_config import ITEMS, SCHEMAS, SYNTHESIS, WIDE_SYNTHESIS

AS_OF = "2024-01-01 10:11:12"
PK1 = ITEMS["PKdesc"]["PK1"]


def _read(spark, d, table):
    return spark.read.parquet(f"{d}/{table}.parquet")


SEEDS = {"customer": "c_custkey", "orders": "o_orderkey"}


def _keys(spark, d, config=SYNTHESIS, chained=True, table="customer"):
    return synthesize.build_keyfile(_read(spark, d, table), SCHEMAS, config, appname="app", version="1", starting_id=0,
                                    seed=SEEDS[table], chained=chained, as_of=AS_OF)


def items(spark, d):
    return amplify.amplify(_keys(spark, d), PK1, as_of=AS_OF, distinct=True, rows_per_task=amplify.ROWS_PER_TASK)


#: Column definitions that the sample doesn't have, over the order keys.
COLUMNS = {
    "basemap": {"base": {"minVal": 10, "maxVal": 1000, "step": 7}},
    "keymap": {
        "linked": {"minVal": 100, "maxVal": 400, "step": 3, "baseCol": "base"},
        "prefixed": {"minVal": 1, "maxVal": 99, "baseCol": "base", "prefix": "P-"},
        "day": {"datatype": "date", "genType": "dateRange", "minVal": "20240115", "maxVal": "20240310"},
        "soon": {"datatype": "date", "genType": "deltaDays", "deltaDays": 30},
        "later": {"datatype": "date", "genType": "columnBasedDeltaDays", "deltaDays": 2, "baseCol": "day"},
        "word": {"datatype": "faker", "fakerText": "word", "options": ["a", "b", "a", "c"], "baseCol": "linked"},
        "person": {"datatype": "faker", "fakerText": "name", "baseCol": "base"},
        "fixed": {"datatype": "confdate", "val": "2022-10-24"},
        "sql": {"datatype": "confval", "val": "base div 2"},
    },
}


def _columns(schema):
    """Generated columns for each order."""
    return lambda spark, d: synthesize.synth_rows(_read(spark, d, "orders"), schema, COLUMNS, seed="o_orderkey", as_of=AS_OF)


def _column(name, kind="STRING"):
    return _columns(f"{name} {kind}")


def _base(spark, d):
    return _read(spark, d, "orders").select("o_orderkey", g.ranged(F.col("o_orderkey"), 10, 1000, 7).alias("base"))


def _alias(spark, d):
    return synthesize.synth_rows(_read(spark, d, "orders"), "department_id STRING, dept_id STRING", SYNTHESIS, seed="o_orderkey", as_of=AS_OF)


def _table(name, config=SYNTHESIS, schema=None, **options):
    return lambda s, d: synthesize.synth_table(_read(s, d, "orders"), schema or SCHEMAS[name], config, seed="o_orderkey", as_of=AS_OF, **options)


def _all_tables(spark, d):
    """All tables as one, each row with the name of its table; columns that a table hasn't are null."""
    made = synthesize.synth_all(_read(spark, d, "orders"), SCHEMAS, SYNTHESIS, seed="o_orderkey", as_of=AS_OF)
    return amplify.union_families(made).withColumnRenamed("family", "table_name")


def _pk(spark, d):
    return amplify.partition_keys(_keys(spark, d), PK1, AS_OF).select("empid", "PK", "ADDITIONAL_PK")


def _sk(spec):
    return lambda s, d: amplify.sort_keys(amplify.partition_keys(_keys(s, d), PK1, AS_OF), spec).select("empid", "SK")


def _attribute(name, props):
    """An attribute over one item per key."""
    spec = {**PK1, "SK": {"type": "conf", "val": "employee_id"}, "Attrs": ["create_time", name] if name != "create_time" else [name], name: props}
    return lambda s, d: amplify.amplify(_keys(s, d), spec, as_of=AS_OF).select("SK", "PK", name)


#: The items of an order go from its day to a common one: ranges of very different lengths.
UNEVEN = {"SQL": "concat('O', o_orderkey)", "SK": {"type": "daterange", "start": "o_orderdate", "end": "as_of", "format": "yyyy-MM-dd", "interval_in_days": 90}, "Attrs": ["n"],
          "n": {"type": "sql", "attr_SQL": "datediff(as_of, to_date(SK))"}}


def uneven_items(spark, d):
    keys = _read(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return amplify.amplify(keys, UNEVEN, as_of="2001-09-01 10:11:12", distinct=True, rows_per_task=amplify.ROWS_PER_TASK).select("PK", "SK", "n")


FAMILIES = {"PKlst": ["PK1", "PK2"], "PKdesc": {
    "PK1": {**PK1, "SK": {"type": "conf", "val": "employee_id"}, "Attrs": ["kind"], "kind": {"type": "string", "str": "first"}},
    "PK2": {"SQL": "concat('C', company_id)", "SK": {"type": "conf", "val": "cast(department_id as string)"}, "Attrs": ["note"], "note": {"type": "sql", "attr_SQL": "concat(PK, '/', SK)"}}}}


def _families(spark, d):
    return amplify.union_families(amplify.amplify_families(_keys(spark, d), FAMILIES, as_of=AS_OF, distinct=True)).select(
        "family", "PK", "SK", "ADDITIONAL_PK", "kind", "note")


def _put(spark, d):
    orders = _read(spark, d, "orders")
    item = orders.select(F.concat(F.lit("C"), F.col("o_custkey")).alias("PK"), F.col("o_orderpriority").alias("SK"),
                         F.col("o_orderkey").alias("number"), F.col("o_orderstatus").alias("status"))
    return amplify.put_items(item.where("number % 3 <> 0"), item.where("number % 3 = 0"), order_by="number")


#: Lines of a task that makes documents and reads them: what a task holds doesn't grow with the tables.
LINES_PER_TASK = 100_000


def documents(spark, d):
    """A nested document for each order that has lines: key, customer, and lines with their part, nested once more."""
    lineitem = _read(spark, d, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-lineitem.count() // LINES_PER_TASK))
    line = F.struct(F.col("l_linenumber").alias("no"), F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("flag")).alias("part"),
                    F.col("l_quantity").cast("int").alias("qty"))
    lines = lineitem.repartition(tasks, "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    orders = _read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").repartition(tasks, "o_orderkey")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(F.col("o_orderkey").alias("doc_id"), F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("flag"), F.struct(F.col("o_custkey").alias("id")).alias("customer"), "lines")).alias("doc"))


def _lookup(spark, d):
    found = documents(spark, d).select("doc_id", F.posexplode(nested.lookup(F.col("doc"), "id")).alias("pos", "hit"))
    return found.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "hit.path", "hit.value")


def _lookup_wild(spark, d):
    found = documents(spark, d).select("doc_id", F.explode(nested.lookup(F.col("doc"), "NE", wild=True)).alias("hit"))
    return found.groupBy("hit.key").agg(F.count("*").alias("n"))


def _lookup_with_keys(spark, d):
    found = documents(spark, d).select("doc_id", F.explode(nested.lookup_with_keys(F.col("doc"), "a", wild=True)).alias("key", "values"))
    return found.select("doc_id", "key", F.size("values").cast("bigint").alias("n"), F.element_at("values", 1).alias("first"))


def _all_keys(spark, d):
    return documents(spark, d).select("doc_id", F.explode(nested.all_keys(F.col("doc"))).alias("key")).groupBy("doc_id", "key").agg(F.count("*").alias("n"))


def _value_parents(spark, d):
    held = documents(spark, d).select("doc_id", F.explode(nested.value_parents(F.col("doc"), "R")).alias("found"))
    return held.select("doc_id", "found.path", nested.key_count(F.col("found.parent"), "id").alias("ids"))


def _occurrences(spark, d):
    return nested.value_occurrences(documents(spark, d), "doc", "R")[0]


def _after_edit(edit):
    """What an edited document holds: its ids in order, the flags, the number of keys."""
    def query(spark, d):
        changed = documents(spark, d).select("doc_id", edit(F.col("doc")).alias("doc"))
        found = changed.select("doc_id", nested.ask(F.col("doc"), ids=nested.find_values("id"), flags=nested.find_values("flag"), keys=nested.find_keys()).alias("found"))
        values = lambda name: F.array_join(F.transform(f"found.{name}", lambda n: n["value"]), ";")
        return found.select("doc_id", values("ids").alias("ids"), values("flags").alias("flags"), F.size("found.keys").cast("bigint").alias("n_keys"))
    return query


def large_documents(spark, d):
    """A document for each customer that has ordered: all orders, each with its lines."""
    line = F.struct(F.struct(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("flag")).alias("part"), F.col("l_quantity").cast("int").alias("qty"), F.col("l_linenumber").alias("no"))
    lines = _read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    orders = _read(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), "lines"))).alias("orders"))
    return orders.select(F.col("o_custkey").alias("doc_id"), F.to_json(F.struct(F.col("o_custkey").alias("id"), "orders")).alias("doc"))


def _update_large(spark, d):
    changed = large_documents(spark, d).select("doc_id", nested.update(F.col("doc"), "part", {"id": 0}).alias("doc"))
    return changed.select("doc_id", F.md5("doc").alias("doc_md5"), nested.key_count(F.col("doc"), "id").alias("ids"))


def chains(spark, d):
    """A document for each order: its lines one inside the other, so that documents differ in depth."""
    lines = _read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("lines"))
    chained = F.aggregate(F.reverse("lines"), F.lit("null"), lambda inner, x: F.concat(F.lit('{"no":'), x["l_linenumber"], F.lit(',"next":'), inner, F.lit("}")))
    return lines.select(F.col("l_orderkey").alias("doc_id"), chained.alias("doc"))


#: Fifty parts of keys, of which some are in the keys of the documents.
PATTERNS = ["id", "ne", "flag", "LA", "art", "qty", "no", "cust", "e", "lines"] + [f"{a}{b}" for a in "bdghjkvw" for b in "xyzqp"]


def _lookup_many(spark, d):
    found = documents(spark, d).select("doc_id", F.explode(nested.lookup_many(F.col("doc"), PATTERNS, wild=True)).alias("hit"))
    return found.groupBy("doc_id", "hit.pattern", "hit.key").agg(F.count("*").alias("n"), F.min("hit.path").alias("first_path"))


def _nodes(spark, d):
    return nested.json_nodes(documents(spark, d), "doc_id", "doc").select("doc_id", "node", "parent", "key", "kind", "depth", "value")


def _node_parents(spark, d):
    """Objects that hold the text R directly, by a join of the values with themselves."""
    nodes = nested.json_nodes(documents(spark, d), "doc_id", "doc").where("counts")
    held = nodes.where("kind = 'string' AND value = 'R' AND key IS NOT NULL").groupBy("doc_id", F.col("parent").alias("node")).agg(F.count("*").alias("n_held"))
    # what holds a value under a key is an object: no other node is exchanged
    objects = nodes.where("kind = 'object'").select("doc_id", "node", "depth", "key", (F.col("end") - F.col("start")).alias("n_bytes"))
    return objects.join(held, ["doc_id", "node"]).select("doc_id", "node", "depth", "key", "n_held", "n_bytes")


def _plus(amount):
    return lambda v: F.try_variant_get(v, "$", "bigint") + amount


QUERIES = {
    "gen_base_range": _base, "gen_key_range": _column("linked", "BIGINT"), "gen_prefix": _column("prefixed"), "gen_alias": _alias,
    "gen_date_range": _column("day"), "gen_delta_days": _columns("linked BIGINT, soon STRING"), "gen_column_delta_days": _column("later"),
    "gen_word_choice": _column("word"), "gen_fake_text": _column("person"), "gen_const_date": _columns("linked BIGINT, fixed STRING"), "gen_sql_expr": _column("sql", "INT"),
    "gen_null_column": _columns("unknown DECIMAL(10,2), linked BIGINT"),
    "synth_table": _table("department"), "synth_employee": _table("employee"), "synth_compat": _table("department", chained=False),
    "distinct_rows": lambda s, d: synthesize.synth_rows(_read(s, d, "orders"), SCHEMAS["employee"], SYNTHESIS, seed="o_orderkey", as_of=AS_OF).distinct(),
    "synth_merged": _table("", COLUMNS, "sql INT, word STRING"), "synth_all": _all_tables, "build_keyfile": _keys,
    "amp_pk": _pk,
    "amp_additional_pk": lambda s, d: amplify.partition_keys(_keys(s, d), {"SQL": PK1["SQL"]}, AS_OF).select("empid", "ADDITIONAL_PK"), "amp_sk_conf": _sk({**PK1, "SK": {"type": "conf", "val": "concat(company_id, '#', training_id)"}}), "amp_sk_daterange": _sk(PK1),
    "attr_json": _attribute("attr1", PK1["attr1"]), "attr_audit_date": _attribute("create_time", PK1["create_time"]),
    "attr_relative_date": _attribute("expTm", PK1["expTm"]), "attr_string": _attribute("text", {"type": "string", "str": "fixed"}),
    "attr_sql": _attribute("sqltypeattr", PK1["sqltypeattr"]),
    "attr_unix_time": _attribute("seconds", {"type": "sql", "attr_SQL": "unix_timestamp(date_add(to_date(create_time), cast(substr(SK, 5) as int) % 50))"}), "amp_families": _families, "amplify_items": items, "amp_uneven_range": uneven_items,
    "put_items": _put,
    "check_fk": lambda s, d: checks.foreign_key_violations(_read(s, d, "lineitem"), "l_orderkey", _read(s, d, "orders").where("o_orderstatus <> 'P'"), "o_orderkey"),
    "check_pk": lambda s, d: checks.primary_key_violations(_read(s, d, "lineitem"), ["l_orderkey", "l_partkey"]),
    "check_fd": lambda s, d: checks.dependency_violations(synthesize.synth_rows(_read(s, d, "orders"), SCHEMAS["department"], SYNTHESIS, seed="o_orderkey",
                                                                                chained=False, as_of=AS_OF), "department_id", "costcenter"),
    "check_item_keys": lambda s, d: checks.item_key_violations(amplify.amplify(_keys(s, d, table="orders"), {**PK1, "SK": {"type": "conf", "val": "company_id"}, "Attrs": []}, as_of=AS_OF)),
    "check_fanout": lambda s, d: amplify.fan_out_of_keys(_keys(s, d), PK1, as_of=AS_OF, distinct=True),
    "wide_items": lambda s, d: checks.fan_out(amplify.amplify(_keys(s, d, WIDE_SYNTHESIS, table="orders"), PK1, as_of=AS_OF, distinct=True,
                                                             rows_per_task=amplify.ROWS_PER_TASK)),
    "json_lookup": _lookup, "json_lookup_wild": _lookup_wild, "json_lookup_with_keys": _lookup_with_keys, "json_all_keys": _all_keys,
    "json_key_count": lambda s, d: documents(s, d).select("doc_id", nested.key_count(F.col("doc"), "id").alias("n")),
    "json_value_count": lambda s, d: documents(s, d).select("doc_id", nested.ask(F.col("doc"), n=nested.count_value("R"), n7=nested.count_value(7)).alias("found")).select(
        "doc_id", "found.n", "found.n7"),
    "json_value_parents": _value_parents, "json_value_occurrences": _occurrences,
    "json_update": _after_edit(lambda doc: nested.update(doc, "part", {"id": 0})), "json_update_multi": _after_edit(lambda doc: nested.update_each(doc, "id", [1, 2, 3])),
    "json_delete": _after_edit(lambda doc: nested.delete(doc, "flag")), "json_alter": _after_edit(lambda doc: nested.alter(doc, "id", _plus(100))),
    "json_alter_wild": _after_edit(lambda doc: nested.alter(doc, "FLA", lambda v: F.concat(F.try_variant_get(v, "$", "string"), F.lit("!")), wild=True)),
    "json_alter_converted": _after_edit(lambda doc: nested.alter(doc, "id", lambda v, sign: F.concat(v, F.lit(sign)), parameters=["#"],
                                                              conversion=lambda v: F.try_variant_get(v, "$", "string"))),
    "json_update_large": _update_large, "json_lookup_many": _lookup_many, "json_nodes": _nodes, "json_node_parents": _node_parents,
    "json_max_depth": lambda s, d: chains(s, d).select("doc_id", nested.json_depth(F.col("doc")).alias("depth")),
    "json_events": lambda s, d: _read(s, d, "events").select("event_id", nested.key_count(F.col("props"), "k").alias("n"), nested.json_error(F.col("props")).alias("error")),
}

_PICK = "CAST(('0x' || substr(md5(CAST({x} AS VARCHAR)), {at}, 8)) AS BIGINT) % {n}"
#: Chained keys of a seed, step by step.
_CHAIN = """SELECT id, empid, deptid, 1000 + deptid % 1001 AS companyid, 'X' || (100000 + empid % 100001) AS employee_id,
    CAST(4000 + empid % 1001 AS VARCHAR) AS department_id, CAST(1000 + deptid % 1001 AS VARCHAR) AS costcenter,
    CAST(1000 + deptid % 1001 AS VARCHAR) AS company_id, CAST(100 + deptid % 101 AS VARCHAR) AS training_id FROM (
    SELECT *, 4000 + empid % 1001 AS deptid FROM (SELECT {seed} AS id, 10000 + {seed} % 10001 AS empid FROM {table}))"""
_CUSTOMERS, _ORDERS = _CHAIN.format(seed="c_custkey", table="customer"), _CHAIN.format(seed="o_orderkey", table="orders")
# lpad cuts on the right of the joined text
_PARTITION_KEYS = """SELECT *, lpad(lpad(employee_id, 10, '0') || '-' || lpad(department_id, 10, '0'), 22, 'X-') AS PK,
    lpad(lpad(costcenter, 10, '0') || '-' || lpad(department_id, 10, '0'), 22, 'X-') AS ADDITIONAL_PK FROM ({})"""
_PKS = _PARTITION_KEYS.format(_CUSTOMERS)
_DAYS = """SELECT strftime(DATE '2023-10-02' + CAST(i AS INTEGER), '%Y-%m-%d 00:00:00') AS SK FROM range(92) t(i)"""
_LEVEL = "list_extract(['L1','L2','L3','L4','L5'], CAST(1 + " + _PICK.format(x="employee_id", at=1, n=5) + " AS INTEGER))"
_TRAINING = "list_extract(['ethics','security'], CAST(1 + " + _PICK.format(x="training_id", at=1, n=2) + " AS INTEGER))"
_COLS = "SELECT o_orderkey, 10 + (o_orderkey % 142) * 7 AS base FROM orders"
_ITEM = f"""SELECT DISTINCT PK, ADDITIONAL_PK FROM ({_PKS})"""
_DOCS = """SELECT o_orderkey AS doc_id, o_orderstatus AS status, o_custkey AS cust, list({'no': l_linenumber, 'pid': l_partkey, 'flag': l_returnflag, 'qty': l_quantity::INT}
    ORDER BY l_linenumber, l_partkey, l_returnflag, l_quantity::INT) AS ls FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"""
_ROOTS = f"""SELECT doc_id, to_json({{'id': doc_id, 'flag': status, 'customer': {{'id': cust}},
    'lines': list_transform(ls, lambda l: {{'no': l.no, 'part': {{'id': l.pid, 'flag': l.flag}}, 'qty': l.qty}})}}) AS doc FROM ({_DOCS})"""
_TREE = f"""SELECT d.doc_id, j.key, j.path, j.atom, j.type, j.id AS "at" FROM ({_ROOTS}) d, json_tree(d.doc) j"""


def _edited(ids: str, flags: str, keys: str) -> str:
    return f"SELECT doc_id, {ids} AS ids, {flags} AS flags, CAST({keys} AS BIGINT) AS n_keys FROM ({_DOCS})"


_FLAGS = """'"' || status || '"' || list_aggregate(list_transform(ls, lambda l: ';"' || l.flag || '"'), 'string_agg', '')"""
_IDS = "doc_id || ';' || cust || list_aggregate(list_transform(ls, lambda l: ';' || l.pid), 'string_agg', '')"
_FIRST = "list_extract(['Ada','Bela','Chidi','Dora','Emil','Farah','Goran','Hana','Ines','Jonas','Kira','Luis'], CAST(1 + {} AS INTEGER))"
_LAST = "list_extract(['Abara','Berg','Castro','Dietz','Eriksen','Fontaine','Gupta','Horvat','Ito','Jansen','Kowal'], CAST(1 + {} AS INTEGER))"


def _one_item(value: str, name: str) -> str:
    return f"SELECT employee_id AS SK, PK, {value} AS {name} FROM ({_PKS})"


SQL = {
    "gen_base_range": _COLS,
    "gen_key_range": f"SELECT 100 + (base % 101) * 3 AS linked FROM ({_COLS})",
    "gen_prefix": f"SELECT 'P-' || (1 + base % 99) AS prefixed FROM ({_COLS})",
    "gen_alias": f"SELECT department_id, department_id AS dept_id FROM ({_ORDERS})",
    "gen_date_range": "SELECT strftime(DATE '2024-01-15' + CAST(o_orderkey % 56 AS INTEGER), '%Y%m%d') AS day FROM orders",
    "gen_delta_days": f"SELECT 100 + (base % 101) * 3 AS linked, '20240131' AS soon FROM ({_COLS})",
    "gen_column_delta_days": "SELECT strftime(DATE '2024-01-17' + CAST(o_orderkey % 56 AS INTEGER), '%Y%m%d') AS later FROM orders",
    "gen_word_choice": f"SELECT list_extract(['a','b','a','c'], CAST(1 + {_PICK.format(x='100 + (base % 101) * 3', at=1, n=4)} AS INTEGER)) AS word FROM ({_COLS})",
    "gen_fake_text": f"""SELECT {_FIRST.format(_PICK.format(x="'person:' || base", at=1, n=12))} || ' ' || {_LAST.format(_PICK.format(x="'person:' || base", at=9, n=11))} AS person
        FROM ({_COLS})""",
    "gen_const_date": f"SELECT 100 + (base % 101) * 3 AS linked, '20221024' AS fixed FROM ({_COLS})",
    "gen_sql_expr": f"SELECT CAST(base // 2 AS INTEGER) AS sql FROM ({_COLS})",
    "gen_null_column": f"SELECT CAST(NULL AS DECIMAL(10,2)) AS unknown, 100 + (base % 101) * 3 AS linked FROM ({_COLS})",
    "synth_table": f"SELECT DISTINCT department_id, costcenter, CAST(NULL AS VARCHAR) AS dept_name FROM ({_ORDERS})",
    "synth_employee": f"""SELECT DISTINCT employee_id, department_id AS dept_id, {_LEVEL} AS employee_level, '20240111' AS employment_start_dt,
        CAST(NULL AS VARCHAR) AS increment_dt FROM ({_ORDERS})""",
    "distinct_rows": f"""SELECT DISTINCT employee_id, department_id AS dept_id, {_LEVEL} AS employee_level, '20240111' AS employment_start_dt,
        CAST(NULL AS VARCHAR) AS increment_dt FROM ({_ORDERS})""",
    "synth_compat": """SELECT DISTINCT CAST(4000 + (10000 + o_orderkey % 10001) % 1001 AS VARCHAR) AS department_id,
        CAST(1000 + (4000 + o_orderkey % 1001) % 1001 AS VARCHAR) AS costcenter, CAST(NULL AS VARCHAR) AS dept_name FROM orders""",
    "synth_merged": f"""SELECT DISTINCT CAST(base // 2 AS INTEGER) AS sql,
        list_extract(['a','b','a','c'], CAST(1 + {_PICK.format(x='100 + (base % 101) * 3', at=1, n=4)} AS INTEGER)) AS word FROM ({_COLS})""",
    "synth_all": f"""WITH o AS ({_ORDERS}) SELECT DISTINCT 'department' AS table_name, department_id, costcenter, CAST(NULL AS VARCHAR) AS dept_name FROM o
        UNION ALL BY NAME SELECT DISTINCT 'employee' AS table_name, employee_id, department_id AS dept_id, {_LEVEL} AS employee_level, '20240111' AS employment_start_dt,
            CAST(NULL AS VARCHAR) AS increment_dt FROM o
        UNION ALL BY NAME SELECT DISTINCT 'company' AS table_name, company_id, CAST(NULL AS VARCHAR) AS company_start_dt FROM o
        UNION ALL BY NAME SELECT DISTINCT 'trainings' AS table_name, training_id, {_TRAINING} AS training_name FROM o""",
    "build_keyfile": f"""SELECT empid, deptid, companyid, department_id::BIGINT AS department_id, costcenter::BIGINT AS costcenter, employee_id, department_id::BIGINT AS dept_id,
        {_LEVEL} AS employee_employee_level, '20240111' AS employee_employment_start_dt, company_id::BIGINT AS company_id, training_id::BIGINT AS training_id,
        {_TRAINING} AS trainings_training_name, 'app' AS appname, '1' AS version, CAST(0 AS BIGINT) AS startingId, '20240101' AS dt FROM ({_CUSTOMERS})""",
    "amp_pk": f"SELECT empid, PK, ADDITIONAL_PK FROM ({_PKS})",
    "amp_additional_pk": f"SELECT empid, 'NA' AS ADDITIONAL_PK FROM ({_CUSTOMERS})",
    "amp_sk_conf": f"SELECT empid, company_id || '#' || training_id AS SK FROM ({_PKS})",
    "amp_sk_daterange": f"SELECT empid, SK FROM ({_PKS}), ({_DAYS})",
    "attr_json": _one_item("""'{"employee_id": "' || split_part(PK, '-', 1) || '", "dept_id": "' || split_part(PK, '-', 2) || '", "status_update": "'
        || split_part(ADDITIONAL_PK, '-', 1) || '"}'""", "attr1"),
    "attr_audit_date": _one_item("'2024-01-01 00:00:00'", "create_time"),
    "attr_relative_date": _one_item("CAST(epoch(DATE '2024-01-01' + 100) AS BIGINT)", "expTm"),
    "attr_string": _one_item("'fixed'", "text"),
    "attr_sql": _one_item("split_part(PK, '-', 1)", "sqltypeattr"),
    "attr_unix_time": _one_item("CAST(epoch(DATE '2024-01-01' + CAST(CAST(substr(employee_id, 5) AS INTEGER) % 50 AS INTEGER)) AS BIGINT)", "seconds"),
    "amp_families": f"""SELECT DISTINCT 'PK1' AS family, PK, employee_id AS SK, ADDITIONAL_PK, 'first' AS kind, CAST(NULL AS VARCHAR) AS note FROM ({_PKS})
        UNION ALL SELECT DISTINCT 'PK2', 'C' || company_id, department_id, 'NA', CAST(NULL AS VARCHAR), 'C' || company_id || '/' || department_id FROM ({_CUSTOMERS})""",
    "amplify_items": f"""SELECT PK, SK, ADDITIONAL_PK, '{{"employee_id": "' || split_part(PK, '-', 1) || '", "dept_id": "' || split_part(PK, '-', 2) || '", "status_update": "'
        || split_part(ADDITIONAL_PK, '-', 1) || '"}}' AS attr1, '2024-01-01 00:00:00' AS create_time, CAST(1712707200 AS BIGINT) AS expTm,
        split_part(PK, '-', 1) AS sqltypeattr FROM ({_ITEM}), ({_DAYS})""",
    "amp_uneven_range": """SELECT 'O' || o_orderkey AS PK, strftime(day, '%Y-%m-%d') AS SK, CAST(date_diff('day', CAST(day AS DATE), DATE '2001-09-01') AS INTEGER) AS n FROM (
        SELECT o_orderkey, unnest(generate_series(o_orderdate, TIMESTAMP '2001-09-01 10:11:12', INTERVAL 90 DAY)) AS day FROM orders)""",
    "put_items": """SELECT 'C' || o_custkey AS PK, o_orderpriority AS SK, o_orderkey AS number, o_orderstatus AS status FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey % 3 = 0 DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
    "check_fk": """SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""",
    "check_pk": "SELECT l_orderkey, l_partkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "check_fd": """SELECT department_id, count(DISTINCT costcenter) AS n_values FROM (SELECT CAST(4000 + (10000 + o_orderkey % 10001) % 1001 AS VARCHAR) AS department_id,
        1000 + (4000 + o_orderkey % 1001) % 1001 AS costcenter FROM orders) GROUP BY 1 HAVING count(DISTINCT costcenter) > 1""",
    "check_item_keys": f"SELECT PK, CAST(company_id AS BIGINT) AS SK, count(*) AS n_rows FROM ({_PARTITION_KEYS.format(_ORDERS)}) GROUP BY ALL HAVING count(*) > 1",
    "check_fanout": f"SELECT PK, CAST(92 * count(DISTINCT ADDITIONAL_PK) AS BIGINT) AS n_items FROM ({_PKS}) GROUP BY 1",
    "wide_items": """SELECT lpad(lpad('X' || e, 10, '0') || '-' || lpad(CAST(1 + b % 20000000 AS VARCHAR), 10, '0'), 22, 'X-') AS PK, CAST(92 AS BIGINT) AS n_items
        FROM (SELECT DISTINCT 1 + (1 + o_orderkey % 2000000000) % 2000000000 AS e, 1 + o_orderkey % 2000000000 AS b FROM orders) GROUP BY ALL""",
    "json_lookup": f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY "at") - 1 AS pos,
        replace(replace(replace(substr(path, 2), '.', '/'), '[', '/'), ']', '') || '/id' AS path, atom::VARCHAR AS value FROM ({_TREE}) WHERE key = 'id'""",
    "json_lookup_wild": f"SELECT key, count(*) AS n FROM ({_TREE}) WHERE contains(lower(key), 'ne') GROUP BY 1",
    "json_lookup_with_keys": f"""SELECT doc_id, 'flag' AS key, CAST(1 + len(ls) AS BIGINT) AS n, '"' || status || '"' AS first FROM ({_DOCS})
        UNION ALL SELECT doc_id, 'part', CAST(len(ls) AS BIGINT), '{{"id":' || ls[1].pid || ',"flag":"' || ls[1].flag || '"}}' FROM ({_DOCS})""",
    "json_all_keys": f"""SELECT doc_id, key, count(*) AS n FROM ({_TREE}) WHERE key IS NOT NULL AND NOT regexp_matches(key, '^[0-9]+$') GROUP BY ALL""",
    "json_key_count": f"SELECT doc_id, count(*) AS n FROM ({_TREE}) WHERE key = 'id' AND type <> 'NULL' GROUP BY 1",
    "json_value_count": f"""SELECT doc_id, count(*) FILTER (atom::VARCHAR = '"R"') AS n, count(*) FILTER (atom::VARCHAR = '7') AS n7 FROM ({_TREE}) GROUP BY 1""",
    "json_value_parents": f"""SELECT doc_id, '/lines/' || i || '/part' AS path, CAST(1 AS BIGINT) AS ids FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS i FROM ({_DOCS}))
        WHERE l.flag = 'R' UNION ALL SELECT doc_id, '', CAST(2 + len(ls) AS BIGINT) FROM ({_DOCS}) WHERE status = 'R'""",
    "json_value_occurrences": f"""SELECT count(*) AS occurrences FROM ({_TREE}) WHERE atom::VARCHAR = '"R"'""",
    "json_update": _edited("doc_id || ';' || cust || repeat(';0', len(ls))", """'"' || status || '"'""", "5 + 4 * len(ls)"),
    "json_update_multi": _edited("'1;2' || repeat(';3', len(ls))", _FLAGS, "5 + 5 * len(ls)"),
    "json_delete": _edited(_IDS, "''", "4 + 4 * len(ls)"),
    "json_alter": _edited("(doc_id + 100) || ';' || (cust + 100) || list_aggregate(list_transform(ls, lambda l: ';' || (l.pid + 100)), 'string_agg', '')", _FLAGS, "5 + 5 * len(ls)"),
    "json_alter_wild": _edited(_IDS, """'"' || status || '!"' || list_aggregate(list_transform(ls, lambda l: ';"' || l.flag || '!"'), 'string_agg', '')""", "5 + 5 * len(ls)"),
    "json_alter_converted": _edited("""'"' || doc_id || '#";"' || cust || '#"' || list_aggregate(list_transform(ls, lambda l: ';"' || l.pid || '#"'), 'string_agg', '')""", _FLAGS,
                                    "5 + 5 * len(ls)"),
    "json_update_large": """SELECT o_custkey AS doc_id, md5(CAST(to_json({'id': o_custkey, 'orders': list({'id': o_orderkey, 'lines': ls} ORDER BY o_orderkey)}) AS VARCHAR)) AS doc_md5,
        CAST(1 + sum(1 + len(ls)) AS BIGINT) AS ids FROM (SELECT o_custkey, o_orderkey, list({'part': {'id': 0}, 'qty': l_quantity::INT, 'no': l_linenumber}
            ORDER BY l_partkey, l_returnflag, l_quantity::INT, l_linenumber) AS ls FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL) GROUP BY o_custkey""",
    "json_lookup_many": f"""WITH hits AS (SELECT doc_id, key, "at", replace(replace(replace(substr(path, 2), '.', '/'), '[', '/'), ']', '') || '/' || key AS p FROM ({_TREE})
            WHERE key IS NOT NULL AND NOT regexp_matches(key, '^[0-9]+$')),
        patterns AS (SELECT unnest([{", ".join(f"'{x}'" for x in PATTERNS)}]) AS pattern)
        SELECT doc_id, pattern, key, count(*) AS n, min(p) AS first_path FROM hits JOIN patterns ON contains(lower(key), lower(pattern)) GROUP BY ALL""",
    "json_nodes": f"""WITH t AS (SELECT doc_id, j.id AS "at", j.parent AS above, j.key, j.type, j.atom, j.fullkey FROM ({_ROOTS}) d, json_tree(d.doc) j),
        n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "at") - 1 AS node FROM t)
        SELECT n.doc_id, n.node, p.node AS parent, CASE WHEN p.type = 'OBJECT' THEN n.key END AS key,
            CASE n.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'string' ELSE 'number' END AS kind,
            CAST(len(regexp_extract_all(n.fullkey, '[.\\[]')) AS INTEGER) AS depth, n.atom ->> '$' AS value
        FROM n LEFT JOIN n p ON n.doc_id = p.doc_id AND n.above = p."at\"""",
    "json_node_parents": f"""WITH t AS (SELECT doc_id, j.id AS "at", j.parent AS above, j.key, j.value, j.atom, j.type, j.fullkey FROM ({_ROOTS}) d, json_tree(d.doc) j),
        n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY "at") - 1 AS node FROM t),
        held AS (SELECT doc_id, above, count(*) AS n_held FROM t WHERE CAST(atom AS VARCHAR) = '"R"' GROUP BY ALL)
        SELECT doc_id, node, CAST(len(regexp_extract_all(fullkey, '[.\\[]')) AS INTEGER) AS depth, key, n_held, CAST(strlen(CAST(value AS VARCHAR)) AS BIGINT) AS n_bytes
        FROM n JOIN held h USING (doc_id) WHERE h.above = n."at\"""",
    "json_max_depth": "SELECT l_orderkey AS doc_id, count(*) AS depth FROM lineitem GROUP BY 1",
    "json_events": "SELECT event_id, CAST(json_exists(props, '$.k') AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS error FROM events",
}
