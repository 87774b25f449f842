import pytest
from pyspark.sql import functions as F

from keyweave.operators import checks, synthesize
from keyweave.plans.queries import COLUMNS
from keyweave.plans.sample_config import SCHEMAS, SYNTHESIS, WIDE_SYNTHESIS

AS_OF = "2024-01-01 10:11:12"


def table(spark, name, chained, rows=10000, start=500):
    return synthesize.synth_table(synthesize.seed_ids(spark, rows, start), SCHEMAS[name], SYNTHESIS, chained=chained, as_of=AS_OF)


def test_numbers_of_the_survey(spark):
    compat = table(spark, "department", False)
    assert compat.count() == 1500 and compat.select("department_id").distinct().count() == 1001
    assert checks.dependency_violations(compat, "department_id", "costcenter").count() == 499
    assert [table(spark, t, False).count() for t in ("employee", "company", "trainings")] == [10000, 1001, 101]
    chained = table(spark, "department", True)
    assert chained.count() == 1001 and checks.dependency_violations(chained, "department_id", "costcenter").isEmpty()


def test_keys_join_in_any_window(spark):
    employees, departments = table(spark, "employee", True, 3000, 20_000), table(spark, "department", True, 3000, 20_000)
    assert checks.foreign_key_violations(employees, "dept_id", departments, "department_id").isEmpty()
    assert checks.primary_key_violations(departments, "department_id").isEmpty()
    assert checks.dependency_violations(employees, "employee_id", "dept_id").isEmpty()


@pytest.mark.parametrize("schema", ["sql INT", "sql STRING", "word STRING", "word STRING, linked BIGINT", "day DATE, later DATE", "linked BOOLEAN, word STRING",
                                    "person STRING, sql INT", "soon STRING, fixed DATE, unknown DOUBLE", "linked DECIMAL(10,2), prefixed STRING", "linked SMALLINT"])
def test_distinct_rows_of_a_table(spark, schema):
    seeds = synthesize.seed_ids(spark, 400, 3)
    made = synthesize.synth_table(seeds, schema, COLUMNS, as_of=AS_OF)
    plain = synthesize.synth_rows(seeds, schema, COLUMNS, as_of=AS_OF).distinct()
    assert made.schema == plain.schema and sorted(made.collect(), key=str) == sorted(plain.collect(), key=str)


def test_same_rows_for_any_partitioning(spark):
    one, many = (sorted(synthesize.build_keyfile(synthesize.seed_ids(spark, 200, 8, p), SCHEMAS, SYNTHESIS, appname="a", version="1", starting_id=8, as_of=AS_OF).collect(), key=str)
                 for p in (1, 13))
    assert one == many


STEPS = {
    "basemap": {"a": {"minVal": 0, "maxVal": 11}, "b": {"minVal": 5, "maxVal": 40, "step": 4}, "c": {"minVal": 1, "maxVal": 6, "baseCol": "a"}},
    "keymap": {
        "same": {"minVal": 1, "maxVal": 12, "baseCol": "a"}, "less": {"minVal": 1, "maxVal": 5, "baseCol": "a"}, "more": {"minVal": 1, "maxVal": 90, "baseCol": "b"},
        "even": {"minVal": 0, "maxVal": 15, "baseCol": "b"}, "hashed": {"minVal": 1, "maxVal": 50, "baseCol": "a", "baseColType": "hash"}, "twice": {"minVal": 1, "maxVal": 3, "baseCol": "c"},
        "own": {"minVal": 1, "maxVal": 8}, "day": {"datatype": "date", "genType": "dateRange", "minVal": "20240115", "maxVal": "20240120"},
        "after": {"datatype": "date", "genType": "columnBasedDeltaDays", "deltaDays": 2, "baseCol": "day"}, "day2": {"datatype": "date", "genType": "dateRange", "minVal": "20240115", "maxVal": "20240120", "baseCol": "b"},
        "word": {"datatype": "faker", "fakerText": "word", "options": ["x", "y"], "baseCol": "same"}, "free": {"datatype": "faker", "fakerText": "word", "options": ["x", "y"], "baseCol": "id"},
        "fixed": {"datatype": "confdate", "val": "2022-10-24"}, "sql": {"datatype": "confval", "val": "a div 2"}, "seedhash": {"minVal": 1, "maxVal": 9, "baseColType": "hash"}},
}


@pytest.mark.parametrize("schema", [
    "same INT", "less INT", "more INT", "even INT", "hashed INT", "twice INT", "own INT, same INT", "own INT, less INT", "more INT, same STRING, day STRING", "day STRING, after STRING", "day2 STRING",
    "word STRING", "word STRING, same INT", "free STRING", "fixed STRING", "fixed STRING, own INT", "sql INT, own INT", "seedhash INT", "own BOOLEAN", "own BOOLEAN, same INT", "unknown INT"])
@pytest.mark.parametrize("rows,start,chained", [(500, 7, False), (61, 1000, True)])
def test_distinct_rows_of_consecutive_ids(spark, schema, rows, start, chained):
    made = synthesize.synth_window(spark, rows, start, schema, STEPS, chained=chained, as_of=AS_OF)
    plain = synthesize.synth_rows(synthesize.seed_ids(spark, rows, start), schema, STEPS, chained=chained, as_of=AS_OF).distinct()
    assert made.schema == plain.schema and sorted(made.collect(), key=str) == sorted(plain.collect(), key=str)


def test_consecutive_ids_need_no_exchange(spark):
    plan = lambda name, **o: synthesize.synth_window(spark, 10 ** 12, 500, SCHEMAS[name], SYNTHESIS, **o)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan("employee") and "Range (500, 10501" in plan("employee")
    assert "Exchange" not in plan("company", chained=False) and "Range (500, 1501" in plan("company", chained=False)
    assert "Exchange" in plan("department") and "Range (500, 10501" in plan("department")  # ten employees to a department
    assert synthesize.window_of(10 ** 12, SCHEMAS["employee"], WIDE_SYNTHESIS) == (2_000_000_000, True)


def test_batches_are_one_run(spark):
    whole = synthesize.synth_table(synthesize.seed_ids(spark, 100, 5), SCHEMAS["employee"], SYNTHESIS, as_of=AS_OF)
    a, b = synthesize.synth_batches(spark, 50, [5, 55], SCHEMAS["employee"], SYNTHESIS, as_of=AS_OF)
    assert sorted(a.unionByName(b).distinct().collect()) == sorted(whole.collect())
    with pytest.raises(ValueError):
        synthesize.synth_batches(spark, 50, [5, 54], SCHEMAS["employee"], SYNTHESIS)


@pytest.mark.parametrize("config", [
    {"keymap": {"c": {"datatype": "what"}}}, {"keymap": {"c": {"minVal": 1}}}, {"keymap": {"c": {"minVal": 5, "maxVal": 1}}}, {"keymap": {"c": {"minVal": 1, "maxVal": 2, "step": 0}}},
    {"keymap": {"c": {"minVal": 1, "maxVal": 2, "baseCol": "c"}}}, {"keymap": {"c": {"minVal": 1, "maxVal": 2, "baseCol": "none"}}},
    {"keymap": {"c": {"datatype": "faker", "fakerText": "what", "baseCol": "id"}}}, {"keymap": {"c": {"datatype": "date", "genType": "what"}}}])
def test_wrong_definitions_fail_early(spark, config):
    with pytest.raises(ValueError):
        synthesize.synth_table(synthesize.seed_ids(spark, 3), "c STRING", config)


def test_prefix_needs_a_text_column(spark):
    with pytest.raises(ValueError):
        synthesize.synth_table(synthesize.seed_ids(spark, 3), "employee_id INT", SYNTHESIS)


def test_wide_ranges_do_not_repeat(spark):
    made = synthesize.synth_table(synthesize.seed_ids(spark, 50_000), SCHEMAS["employee"], WIDE_SYNTHESIS, as_of=AS_OF)
    assert made.count() == made.select("employee_id").distinct().count() == 50_000


def test_a_distinct_table_has_one_exchange_and_no_python(spark):
    plan = table(spark, "department", True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_nulls_do_not_count_as_dependent_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", "x"), ("b", "y")], "k string, v string")
    assert [r.k for r in checks.dependency_violations(df, "k", "v").collect()] == ["b"]


def test_checks_report_offenders(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    child = spark.createDataFrame([(1,), (3,), (3,), (None,)], "ref int")
    assert [(r.ref, r.n_rows) for r in checks.foreign_key_violations(child, "ref", parent, "id").collect()] == [(3, 2)]
    assert {(r.id, r.n_rows) for r in checks.primary_key_violations(parent, "id").collect()} == {(2, 2), (None, 1)}
    items = spark.createDataFrame([("p", "s"), ("p", "s"), ("p", "t")], "PK string, SK string")
    assert [tuple(r) for r in checks.item_key_violations(items).collect()] == [("p", "s", 2)]
    assert checks.fan_out(items).first().n_items == 3
    assert checks.dependency_violations(items.withColumn("v", F.lit(1)), ["PK", "SK"], ["v"]).isEmpty()


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_keys_in_two_levels(spark, few):
    """Exact however many fingerprints repeat, with nulls, a hot key, and keys of several columns."""
    rows = [(i % 40, f"k{i}") for i in range(60)] + [(7, "k7")] * 300 + [(None, "x"), (None, "x"), (3, None), (None, None)] + [(i, f"k{i}") for i in range(4)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    for key in ("a", "b", ["a", "b"]):
        names = [key] if isinstance(key, str) else key
        want = {}
        for r in rows:
            k = tuple(r["ab".index(n)] for n in names)
            want[k] = want.get(k, 0) + 1
        got = checks.primary_key_violations(df, key, few=few).collect()
        assert {tuple(r)[:-1]: r.n_rows for r in got} == {k: n for k, n in want.items() if n > 1 or None in k} and len(got) == len({tuple(r) for r in got})
    assert checks.primary_key_violations(df.limit(0), "a", few=few).isEmpty()
