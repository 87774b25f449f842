import json

import pytest
from pyspark.sql import functions as F

from keyweave.operators import amplify, synthesize
from keyweave.plans import jobs
from keyweave.plans.sample_config import ITEMS, SCHEMAS, SYNTHESIS
from keyweave.sources import tables

AS_OF = "2024-01-01 10:11:12"
PK1 = ITEMS["PKdesc"]["PK1"]
GOLDEN = "X000X118122-0000004104"


def golden_keys(spark):
    return synthesize.build_keyfile(synthesize.seed_ids(spark, 1, 8122), SCHEMAS, SYNTHESIS, appname="app", version="1", starting_id=8122, chained=False, as_of=AS_OF)


def check_golden(rows):
    assert len(rows) == 92 and {r.PK for r in rows} == {GOLDEN}
    assert min(r.SK for r in rows) == "2023-10-02 00:00:00" and max(r.SK for r in rows) == "2024-01-01 00:00:00"
    for r in rows[:3]:
        assert json.loads(r.attr1) == {"employee_id": "X000X118122", "dept_id": "0000004104", "status_update": "X0000001110"}
        assert (r.create_time, r.expTm, r.sqltypeattr) == ("2024-01-01 00:00:00", 1712707200, "X000X118122")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_golden_row_in_any_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = amplify.amplify(golden_keys(spark), PK1, as_of=AS_OF).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    check_golden(rows)
    assert {r.ADDITIONAL_PK for r in rows} == {"X0000001110-0000004104"}


@pytest.fixture
def job(spark, tmp_path):
    """Options of a synthesis job over empty tables, known by their header files."""
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    headers = {}
    for name, schema in SCHEMAS.items():
        spark.sql(f"DROP TABLE IF EXISTS made.{name}")
        headers[name] = str(tmp_path / f"{name}.csv")
        (tmp_path / f"{name}.csv").write_text(",".join(f.name for f in synthesize.as_schema(schema).fields) + "\n")
    return {"database": "made", "keyfile": str(tmp_path / "keys"), "appname": "app", "headers": headers, "chained": False, "as_of": AS_OF}


def test_jobs_hand_over_the_golden_row(spark, tmp_path, job):
    assert jobs.synthesize_job(spark, SYNTHESIS, rows=5, version="1", starting_id=8120, **job)
    assert jobs.synthesize_job(spark, SYNTHESIS, rows=5, version="2", starting_id=8125, **job)
    assert tables.scan_table(spark, "made.employee").count() == 10
    assert tables.resolve_schema(spark, "made.employee", "/none").fieldNames() == ["employee_id", "dept_id", "employee_level", "employment_start_dt", "increment_dt"]
    keys = tables.scan_keyfile(spark, str(tmp_path / "keys"))
    assert {(r.version, r.dt, r.startingId) for r in keys.collect()} == {("1", "20240101", 8120), ("2", "20240101", 8125)}
    assert dict(keys.dtypes) == dict(synthesize.build_keyfile(synthesize.seed_ids(spark, 1), SCHEMAS, SYNTHESIS, appname="a", version="1", starting_id=1).dtypes)
    assert tables.scan_keyfile(spark, str(tmp_path / "keys"), "version=1").count() == 5
    for part in ("version=1", "version=2", "version=2"):
        jobs.amplify_job(spark, ITEMS, keyfile=str(tmp_path / "keys"), below=part, items=str(tmp_path / "items"), as_of=AS_OF)
    items = spark.read.parquet(str(tmp_path / "items" / "PK1"))
    assert items.count() == 920 and "ADDITIONAL_PK" not in items.columns
    check_golden(items.where(F.col("PK") == GOLDEN).collect())


def everything(spark, job):
    made = {t: sorted(map(str, tables.scan_table(spark, f"made.{t}").collect())) for t in SYNTHESIS["table_list"]}
    return made | {"keys": sorted(map(str, tables.scan_keyfile(spark, job["keyfile"]).collect()))}


@pytest.mark.parametrize("lost", ["employee", "trainings", "keys"])
def test_a_batch_that_was_cut_off_is_made_once(spark, job, monkeypatch, lost):
    """A job dies before it writes one of its tables, or the key file after all of them; the next run leaves what one run leaves."""
    def dies(real, name):
        def write(df, target, *rest):
            if target == name:
                raise RuntimeError("the cluster is gone")
            real(df, target, *rest)
        return write

    jobs.synthesize_job(spark, SYNTHESIS, rows=40, version="1", starting_id=100, **job)
    with monkeypatch.context() as m:
        m.setattr(tables, "write_batch", dies(tables.write_batch, f"made.{lost}"))
        m.setattr(tables, "write_keyfile", dies(tables.write_keyfile, job["keyfile"] if lost == "keys" else ""))
        with pytest.raises(RuntimeError):
            jobs.synthesize_job(spark, SYNTHESIS, rows=40, version="1", starting_id=140, **job)
    assert jobs.synthesize_job(spark, SYNTHESIS, rows=40, version="1", starting_id=140, **job)
    first = everything(spark, job)
    assert len(first["employee"]) == len(first["keys"]) == 80
    assert not jobs.synthesize_job(spark, SYNTHESIS, rows=40, version="1", starting_id=140, **{**job, "as_of": "2024-01-09 00:00:00"})
    assert everything(spark, job) == first


def test_batches_must_not_share_ids(spark, job):
    assert tables.made_batches(spark, job["keyfile"]).isEmpty()
    jobs.synthesize_job(spark, SYNTHESIS, rows=10, version="1", starting_id=100, **job)
    for start, rows in ((109, 5), (91, 10), (100, 9), (95, 100)):
        with pytest.raises(ValueError, match="overlap"):
            jobs.synthesize_job(spark, SYNTHESIS, rows=rows, version="1", starting_id=start, **job)
    assert jobs.synthesize_job(spark, SYNTHESIS, rows=10, version="1", starting_id=110, **job)
    assert jobs.synthesize_job(spark, SYNTHESIS, rows=10, version="2", starting_id=100, **job)
    assert sorted(tuple(r) for r in tables.made_batches(spark, job["keyfile"]).collect()) == [("1", 100, 10), ("1", 110, 10), ("2", 100, 10)]


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_a_put_replaces_only_its_buckets(spark, tmp_path):
    store, path = tmp_path / "store", str(tmp_path / "store")
    rows = [(f"p{i}", f"s{i % 3}", i, "old") for i in range(200)]
    schema = "PK string, SK string, n int, note string"
    tables.put_into(path, spark.createDataFrame(rows, schema), "n", buckets=16)
    before = files(store)
    assert len({x.rpartition("/")[0] for x in before}) == 16
    batch = spark.createDataFrame([("p7", "s1", 1000, True), ("p7", "s9", 1001, None)], "PK string, SK string, n int, extra boolean")
    tables.put_into(path, batch, "n", buckets=16)
    after = files(store)
    changed = {x.rpartition("/")[0] for x in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(after[x] == at for x, at in before.items() if x.rpartition("/")[0] not in changed)
    want = amplify.put_items(spark.createDataFrame(rows, schema), batch, "n")
    assert sorted(map(str, tables.scan_items(spark, path).select(*want.columns).collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="16 buckets"):
        tables.put_into(path, batch, "n", buckets=8)


def test_a_put_that_was_cut_off(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "store"), "PK string, SK string, n int"
    tables.put_into(path, spark.createDataFrame([("a", "1", 1), ("b", "1", 1)], schema), "n", buckets=4)
    with monkeypatch.context() as m:  # staged, but not moved into its bucket
        m.setattr(tables, "_own_partitions_only", lambda spark: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.put_into(path, spark.createDataFrame([("a", "1", 2)], schema), "n", buckets=4)
    assert {r.n for r in tables.scan_items(spark, path).collect()} == {1}
    tables.finish_put(spark, path)
    assert sorted(tuple(r) for r in tables.scan_items(spark, path).select("PK", "n").collect()) == [("a", 2), ("b", 1)]
    (tmp_path / "store" / "_put").mkdir()  # staging itself was cut off
    tables.put_into(path, spark.createDataFrame([("c", "1", 3)], schema), "n", buckets=4)
    assert tables.scan_items(spark, path).count() == 3 and not (tmp_path / "store" / "_put").exists()


def test_tables_may_be_partitioned(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    spark.sql("DROP TABLE IF EXISTS made.parted")
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "id int, dt string")
    tables.append_to_table(df, "made.parted", ["dt"])
    tables.append_to_table(df, "made.parted", ["dt"])
    assert spark.sql("SHOW PARTITIONS made.parted").count() == 2 and tables.scan_table(spark, "made.parted").count() == 4
    with pytest.raises(ValueError):
        tables.resolve_schema(spark, "made.none")


def test_attributes(spark):
    keys = golden_keys(spark)
    spec = {**PK1, "SK": {"type": "conf", "val": "employee_id"}, "Attrs": ["number", "text"], "number": {"type": "string", "str": 7}, "text": {"type": "sql", "attr_SQL": "concat(SK, number)"}}
    (row,) = amplify.amplify(keys, spec, as_of=AS_OF).collect()
    assert row.number == 7 and row.text == "X1181227" and row.SK == "X118122"
    without = amplify.amplify(keys, {**spec, "ADDITIONAL_SQL": None, "Attrs": []}, as_of=AS_OF).first()
    assert without.ADDITIONAL_PK == "NA"
    with pytest.raises(ValueError):
        amplify.amplify(keys, {**spec, "number": {"type": "what"}}, as_of=AS_OF)


def test_repeated_keys_go_before_the_fan_out(spark):
    keys = golden_keys(spark).unionByName(golden_keys(spark))
    assert amplify.amplify(keys, PK1, as_of=AS_OF).count() == 184 and amplify.amplify(keys, PK1, as_of=AS_OF, distinct=True).count() == 92
    assert [amplify.fan_out_of_keys(keys, PK1, as_of=AS_OF, distinct=d).first().n_items for d in (False, True)] == [184, 92]
    conf = {**PK1, "SK": {"type": "conf", "val": "employee_id"}}
    assert amplify.fan_out_of_keys(keys, conf, as_of=AS_OF, distinct=True).first().n_items == 1


def test_templates_at_any_depth():
    with pytest.raises(ValueError):
        amplify.attribute({"type": "nothing"})


def test_json_template(spark):
    template = amplify.json_template('{"a": {"x": [1, {"a": true}]}, "b": null}', {"a": "id"})
    assert spark.range(3, 4).select(template.alias("t")).first().t == '{"a": 3, "b": null}'
    inner = amplify.json_template('{"o": [{"a": 1, "c": "é"}, 2.5]}', {"a": "concat('\"', id)"})
    assert json.loads(spark.range(3, 4).select(inner.alias("t")).first().t) == {"o": [{"a": '"3', "c": "é"}, 2.5]}


def test_put_items(spark):
    schema = "PK string, SK string, n int, m map<string,int>"
    stored = spark.createDataFrame([("a", "1", 9, {"x": 1}), ("b", "1", 9, None), ("b", "1", 8, None)], schema)
    batch = spark.createDataFrame([("a", "1", 1, {"y": 2}), ("a", "1", 2, {"z": 3}), ("c", "1", None, None), ("c", "1", 0, {})], schema)
    out = {(r.PK, r.SK): (r.n, r.m) for r in amplify.put_items(stored, batch, "n").collect()}
    assert out == {("a", "1"): (2, {"z": 3}), ("b", "1"): (9, None), ("c", "1"): (0, {})}
    tied = spark.createDataFrame([("a", "1", 1, {"y": i}) for i in range(9)], schema)
    assert len({str(amplify.put_items(stored, tied.repartition(p), "n").where("PK = 'a'").collect()) for p in (1, 2, 5)}) == 1
    wider = amplify.put_items(stored, batch.withColumn("extra", F.lit(1)).drop("m"), "n")
    assert wider.columns == ["PK", "SK", "n", "m", "extra"] and wider.where("PK = 'b'").first().extra is None


def test_families(spark):
    config = {"PKlst": ["PK1", "PK2"], "PKdesc": {"PK1": PK1, "PK2": {"SQL": "company_id", "SK": {"type": "conf", "val": "'s'"}, "Attrs": []}}}
    both = amplify.union_families(amplify.amplify_families(golden_keys(spark), config, as_of=AS_OF))
    assert {r.family: r["count"] for r in both.groupBy("family").count().collect()} == {"PK1": 92, "PK2": 1}


def task_sizes(df):
    return [r.n for r in df.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()]


UNEVEN = {"SQL": "concat('k', id)", "SK": {"type": "daterange", "start": "opened", "end": "as_of", "format": "yyyy-MM-dd HH:mm", "interval_in_days": 2}, "Attrs": []}


def uneven_keys(spark, copies=1):
    """Ranges from none to very long, bounds that are null, and keys that repeat."""
    from datetime import datetime, timedelta
    end = datetime(2024, 1, 1, 10, 11, 12)
    rows = [(i, end - timedelta(days=d, minutes=i)) for i, d in enumerate([0, 0, 1, 2, 3, 7, 90, 4000] + [5] * 300 + [900] * 4)] + [(999, None)]
    return spark.createDataFrame(rows * copies, "id int, opened timestamp")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("copies,distinct", [(1, False), (3, False), (3, True)])
def test_uneven_ranges_are_the_same_dealt_out(spark, zone, copies, distinct, monkeypatch):
    monkeypatch.setattr(amplify, "LEAST_ROWS", 100)
    keys = uneven_keys(spark, copies)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        plain, dealt = (amplify.amplify(keys, UNEVEN, as_of=AS_OF, distinct=distinct, rows_per_task=n).cache() for n in (None, 700))
        assert sorted(dealt.collect()) == sorted(plain.collect()) and not plain.isEmpty()
        counted = amplify.fan_out_of_keys(keys, UNEVEN, as_of=AS_OF, distinct=distinct).where("n_items > 0")
        assert sorted(counted.collect()) == sorted(plain.groupBy("PK").agg(F.count("*")).collect())
        sizes = task_sizes(dealt)
        assert len(sizes) > 5 and max(sizes) <= 700 and min(sizes[:-1]) >= 0.9 * max(sizes)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_dealing_out_exchanges_keys_only(spark, monkeypatch):
    monkeypatch.setattr(amplify, "LEAST_ROWS", 100)
    items = amplify.amplify(uneven_keys(spark), UNEVEN, as_of=AS_OF, distinct=True, rows_per_task=500)
    plan = items._jdf.queryExecution().executedPlan().toString()
    # the rows are made (the last explode) above every exchange
    assert plan.index("Generate explode(sequence(low") < plan.index("Exchange") and "ShufflePartitionIdPassThrough" in plan or "Exchange" in plan
    sizes = sorted(task_sizes(items))
    assert len(sizes) >= 4 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_a_range_must_not_end_before_it_starts(spark):
    keys = spark.createDataFrame([(1, "2024-02-01")], "id int, day string").withColumn("opened", F.to_timestamp("day"))
    with pytest.raises(Exception, match="ends before it starts"):
        amplify.amplify(keys, UNEVEN, as_of=AS_OF, rows_per_task=10).collect()
    assert amplify.amplify(uneven_keys(spark).where("id = 999"), UNEVEN, as_of=AS_OF, rows_per_task=10).collect() == []


def test_tasks_follow_from_the_rows():
    assert [amplify.tasks_for(rows, 8, 1000) for rows in (0, 1, 9_999, 1_000_001)] == [1, 1, 10, 1001]
    assert amplify.tasks_for(50_000, 8, 1_000_000) == 5 and amplify.tasks_for(5_000_000, 8, 1_000_000) == 8
