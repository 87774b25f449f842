import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyweave.functions import nested as n
from keyweave.functions.json_index import JsonIndex

SIDES = '{"size":3,"left":{"bolt":7},"right":{"bolt":9}}'
WRAPPED = '{"wrap":1,"in":{"wrap":{"wrap":[{"wrap":null}]}}}'
LAMPS = '[{"lamp":5},{"hall":[{"desk":{"lamp":8}}]}]'
COSTS = '{"lamp":5,"hall":[{"desk":{"cost":3}}],"cost":4}'
SWITCHES = '{"on":true,"panel":{"off":false},"high":5,"low":0}'
ROUTE = '{"v":1,"stops":[{"mile":310,"near":[]},{"way":{"mile":742}}],"big":12345678901234567890,"dec":1.10}'
BAD = ["{'a':1}", '{"a":1}{"b":2}', '{"a":1,', "NaN", '{"a":NaN}', "", '{"a" 1}', "[1,]", '{"a":01}', '["\\x"]', '"\t"', "]", "{", '{"a"}', "tru"]


@pytest.fixture
def apply(spark):
    def run(document, *columns):
        row = spark.createDataFrame([(document,)], "doc string").select(*[c(F.col("doc")).alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)
    return run


def values(found):
    return [json.loads(x.value) for x in found]


@pytest.mark.parametrize("doc,key,wild,want", [
    (SIDES, "bolt", False, [7, 9]), (f"[{SIDES}]", "bolt", False, [7, 9]), (f"[[{SIDES}],[[{SIDES}]]]", "bolt", False, [7, 9] * 2), (SIDES, "x", False, []),
    (LAMPS, "lamp", False, [5, 8]), ('{"E_MAIL":1,"x":{"mailbox":2},"y":{"z":3}}', "mail", True, [1, 2]), ('{"a":{"a":{"a":1}}}', "a", False, [{"a": {"a": 1}}, {"a": 1}, 1]),
    ('{"a":null}', "a", False, [None]), ('{"a":1,"a":{"a":2}}', "a", False, [{"a": 2}, 2]), ("5", "a", False, []), ('{"é\\u0041":"\\n"}', "éA", False, ["\n"])])
def test_lookup(apply, doc, key, wild, want):
    assert values(apply(doc, lambda c: n.lookup(c, key, wild=wild))) == want


def test_lookup_of_a_match_in_a_match(apply):
    assert len(apply(WRAPPED, lambda c: n.lookup(c, "wrap"))) == 4
    assert [x.path for x in apply('{"a/b":{"~":[{"k":1},{"k":2}]}}', lambda c: n.lookup(c, "k"))] == ["/a~1b/~0/0/k", "/a~1b/~0/1/k"]


def test_lookup_with_keys_and_all_keys(apply):
    doc = '{"mail":1,"x":{"EMAIL":2,"mail":[3]}}'
    assert apply(doc, lambda c: n.lookup_with_keys(c, "mail", wild=True)) == {"mail": ["1", "[3]"], "EMAIL": ["2"]}
    assert apply(LAMPS, n.all_keys) == ["lamp", "hall", "desk", "lamp"]
    assert apply('[[{"a":1}],{"b":[{"a":2}]}]', n.all_keys) == ["a", "b", "a"]


@pytest.mark.parametrize("key,want", [("a", 2), ("b", 1), ("nil", 0), ("f", 1), ("deep", 0)])
def test_key_count_skips_nulls_and_lists_in_lists(apply, key, want):
    doc = '{"a":{"b":0},"l":[{"a":[]},[{"deep":1}]],"nil":null,"f":false}'
    assert apply(doc, lambda c: n.key_count(c, key)) == want


@pytest.mark.parametrize("doc,value,want", [
    ('{"x":[{"a":1}]}', {"a": 1}, 0), ('{"x":{"a":1}}', {"a": 1}, 1), ('{"x":{"b":2,"a":1}}', {"a": 1, "b": 2}, 1), ('{"x":[1,2],"y":[[1,2]]}', [1, 2], 1),
    ('{"x":["4",4,"4"],"y":"4"}', "4", 3), ('{"x":4,"y":[4.0,4e0]}', 4, 3), ('{"x":true,"y":1}', 1, 1), ('{"x":true,"y":1}', True, 1), ('{"x":[null],"y":null}', None, 2),
    ('{"x":"\\u0034"}', "4", 1), ('{"x":0.5}', 0.5, 1), ("4", 4, 0), ('{"x":[[4]]}', 4, 0)])
def test_value_count(apply, doc, value, want):
    assert apply(doc, lambda c: n.value_count(c, value)) == want


def test_value_parents(apply, spark):
    doc = '{"k":"4","l":[{"a":"4","b":"4"},"4",[{"a":"4"}]],"m":{"n":{"x":"4"}}}'
    assert [x.path for x in apply(doc, lambda c: n.value_parents(c, "4"))] == ["", "/l/0", "/m/n"]
    total, held = n.value_occurrences(spark.createDataFrame([(1, doc), (2, SIDES), (3, '{"x":"4"}')], "id int, doc string"), "doc", "4")
    assert total.first().occurrences == 6 and held.count() == 4 and held.where("id = 3").first().parent == '{"x":"4"}'


@pytest.mark.parametrize("doc,key,value,want", [
    (SIDES, "bolt", 5, '{"size":3,"left":{"bolt":5},"right":{"bolt":5}}'), (SIDES, "x", 5, SIDES), (WRAPPED, "wrap", [1, 2], '{"wrap":[1,2],"in":{"wrap":[1,2]}}'),
    ('{ "a" : 1.10, "b":[1e400,{"k": {"k":1}}] }', "k", None, '{ "a" : 1.10, "b":[1e400,{"k": null}] }'), ('{"é":"ü","k":1}', "k", "ß", '{"é":"ü","k":"\\u00df"}')])
def test_update(apply, doc, key, value, want):
    assert apply(doc, lambda c: n.update(c, key, value)) == want


@pytest.mark.parametrize("doc,key,given,want", [
    (LAMPS, "lamp", [11, 12, 13], '[{"lamp":11},{"hall":[{"desk":{"lamp":12}}]}]'), (LAMPS, "lamp", [7], '[{"lamp":7},{"hall":[{"desk":{"lamp":7}}]}]'),
    ('{"a":{"a":1},"b":{"a":2}}', "a", [10, 20, 30], '{"a":10,"b":{"a":30}}')])
def test_update_each(apply, doc, key, given, want):
    assert apply(doc, lambda c: n.update_each(c, key, given)) == want
    assert apply(doc, lambda c: n.update_each(c, key, F.array(*map(F.lit, given)))) == want
    assert apply(doc, lambda c: n.update_each(c, key, F.array().cast("array<int>"))) == doc


def test_values_must_be_a_list():
    with pytest.raises(ValueError):
        n.update_each(F.lit("{}"), "a", 5)


@pytest.mark.parametrize("doc,key,want", [
    (SWITCHES, "off", '{"on":true,"panel":{},"high":5,"low":0}'), (SWITCHES, "low", '{"on":true,"panel":{"off":false},"high":5}'), (SWITCHES, "on", '{"panel":{"off":false},"high":5,"low":0}'),
    ('{"a":{"a":1},"b":[{"a":1,"c":2},{"a":3}]}', "a", '{"b":[{"c":2},{}]}'), ('{"a":1,"a":2,"b":3,"a":4}', "a", '{"b":3}'), ('{"a":1,"a":2}', "a", "{}"), ('{"b":1 , "a" : 2 }', "a", '{"b":1 }')])
def test_delete(apply, doc, key, want):
    assert apply(doc, lambda c: n.delete(c, key)) == want


def test_alter(apply):
    plus = lambda amount: lambda v: F.variant_get(v, "$", "bigint") + amount
    assert json.loads(apply(ROUTE, lambda c: n.alter(c, "mile", plus(1)))) == {**json.loads(ROUTE), "stops": [{"mile": 311, "near": []}, {"way": {"mile": 743}}]}
    assert apply(LAMPS, lambda c: n.alter(c, "lamp", plus(10))) == '[{"lamp":15},{"hall":[{"desk":{"lamp":18}}]}]'
    assert apply(COSTS, lambda c: n.alter(c, "cost", plus(30))) == '{"lamp":5,"hall":[{"desk":{"cost":33}}],"cost":34}'
    suffix = lambda v, x, y: F.concat(v, F.lit(x), F.lit(y))
    text = lambda v: F.variant_get(v, "$", "string")
    out = apply(ROUTE, lambda c: n.alter(c, ["mile", "v"], suffix, parameters=["k", "m"], conversion=text))
    assert [x["mile"] for x in (json.loads(out)["stops"][0], json.loads(out)["stops"][1]["way"])] == ["310km", "742km"] and json.loads(out)["v"] == "1km"
    assert '"big":12345678901234567890,"dec":1.10' in out
    assert apply('{"Key":1,"xkeyx":2}', lambda c: n.alter(c, "KEY", plus(1), wild=True)) == '{"Key":2,"xkeyx":3}'


def test_alter_from_the_inside_out(apply):
    rename = lambda v: F.replace(F.to_json(v), F.lit('"old"'), F.lit('"new"'))
    out = apply('{"box":{"old":{"box":{"old":1}},"x":[{"box":2},{"box":{"box":"old"}}]}}', lambda c: n.alter(c, "box", lambda v: F.parse_json(rename(v))))
    assert json.loads(out) == {"box": {"new": {"box": {"new": 1}}, "x": [{"box": 2}, {"box": {"box": "new"}}]}}
    count = lambda v: F.concat(F.to_json(v), F.lit("+"))
    assert json.loads(apply('[{"b":{"b":{"b":1},"c":{"b":2}}},{"b":3}]', lambda c: n.alter(c, "b", count))) == [
        {"b": '{"b":"{\\"b\\":\\"1+\\"}+","c":{"b":"2+"}}+'}, {"b": "3+"}]
    with pytest.raises(ValueError):
        n.alter(F.lit("{}"), "a", None)


@pytest.mark.parametrize("depth", [9, 20, 100, 3000])
def test_any_depth(apply, depth):
    doc = '{"k":[' * depth + '{"z":1}' + "]}" * depth
    found, keys, deep, changed, gone = apply(doc, lambda c: F.size(n.lookup(c, "z")), lambda c: F.size(n.all_keys(c)), n.json_depth, lambda c: n.update(c, "z", 2), lambda c: n.delete(c, "z"))
    assert (found, keys, deep) == (1, depth + 1, 2 * depth + 1) and changed == doc.replace('"z":1', '"z":2') and gone == doc.replace('"z":1', "")


@pytest.mark.parametrize("doc", BAD)
def test_malformed_text(apply, doc):
    found, count, keys, depth, changed, gone, altered, error = apply(
        doc, lambda c: n.lookup(c, "a"), lambda c: n.key_count(c, "b"), n.all_keys, n.json_depth, lambda c: n.update(c, "a", 5), lambda c: n.delete(c, "a"),
        lambda c: n.alter(c, "a", lambda v: F.lit(1)), n.json_error)
    assert (found, count, keys, depth) == (None,) * 4 and changed == gone == altered == doc and error


def test_malformed_rows_are_parted(spark):
    rows = [(i, d) for i, d in enumerate([*BAD, SIDES, None, " 5 "])]
    good, bad = n.split_malformed(spark.createDataFrame(rows, "id int, doc string"), "doc")
    assert bad.count() == len(BAD) and {r.doc for r in good.collect()} == {SIDES, None, " 5 "} and good.columns == ["id", "doc"]


def test_edits_one_after_another(spark):
    df = spark.createDataFrame([(SIDES,)], "doc string").withColumn("doc", n.delete(F.col("doc"), "left"))
    df = df.withColumn("doc", n.update(F.col("doc"), "bolt", {"e": 1})).withColumn("found", n.lookup(F.col("doc"), "e"))
    assert values(df.first().found) == [1]


def test_lookup_many(apply):
    doc = '{"mail":1,"x":{"EMAIL":[2],"e":{"mail":3}}}'
    assert [(x.pattern, x.key, x.path, x.value) for x in apply(doc, lambda c: n.lookup_many(c, ["mail", "E", "none"], wild=True))] == [
        ("mail", "mail", "/mail", "1"), ("mail", "EMAIL", "/x/EMAIL", "[2]"), ("E", "EMAIL", "/x/EMAIL", "[2]"), ("E", "e", "/x/e", '{"mail":3}'), ("mail", "mail", "/x/e/mail", "3")]
    assert [(x.pattern, x.value) for x in apply(doc, lambda c: n.lookup_many(c, ["mail", "e", "mail"]))] == [("mail", "1"), ("mail", "1"), ("e", '{"mail":3}'), ("mail", "3"), ("mail", "3")]
    with pytest.raises(ValueError):
        n.lookup_many(F.lit("{}"), [])


def test_several_questions_of_one_reading(spark):
    rows = [(0, SIDES), (1, None), (2, "{"), (3, "[]"), (4, LAMPS)]
    found = spark.createDataFrame(rows, "id int, doc string").select("id", n.ask(
        F.col("doc"), lamps=n.count_key("lamp"), eights=n.count_value(8), deep=n.depth(), keys=n.find_keys(), bolts=n.find_values("bolt")).alias("a")).orderBy("id").select("a.*").collect()
    assert [(r.lamps, r.eights, r.deep, r.keys, r.bolts and values(r.bolts)) for r in found] == [
        (0, 0, 2, ["size", "left", "bolt", "right", "bolt"], [7, 9]), (None,) * 5, (None,) * 5, (0, 0, 1, [], []), (2, 1, 5, ["lamp", "hall", "desk", "lamp"], [])]


def test_batches_cut_by_bytes(spark, monkeypatch):
    """Rows of a batch that is read in many parts keep their order, whatever their sizes."""
    monkeypatch.setattr(n, "BATCH_BYTES", 40)
    docs = ['{"k":' + "[" * (i % 30) + str(i) + "]" * (i % 30) + "}" if i % 7 else [None, "{", ""][i % 3] for i in range(200)]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string").coalesce(1)
    got = df.select("id", "doc", n.lookup(F.col("doc"), "k").alias("found"), n.update(F.col("doc"), "k", F.col("id")).alias("changed"),
                    n.update_each(F.col("doc"), "k", F.array("id")).alias("each"), n.delete(F.col("doc"), "k").alias("gone")).collect()
    for r in got:
        if r.id % 7:
            assert [x.value for x in r.found] == [r.doc[5:-1]] and r.changed == r.each == f'{{"k":{r.id}}}' and r.gone == "{}"
        else:
            assert r.found is None and r.changed == r.each == r.gone == r.doc


def test_many_hits_in_one_document(spark):
    """Edits take time in proportion to the hits."""
    import time
    took = {}
    for hits in (64_000, 2_000, 16_000, 64_000):
        doc = "[" + ",".join('{"a":{"k":%d}}' % i for i in range(hits)) + "]"
        df = spark.createDataFrame([(doc,)], "doc string").cache()
        df.count()
        began = time.perf_counter()
        row = df.select(n.update(F.col("doc"), "k", 0).alias("u"), n.delete(F.col("doc"), "k").alias("d"),
                        n.alter(F.col("doc"), ["k", "a"], lambda v: F.coalesce(F.try_variant_get(v, "$", "bigint") + 1, F.lit(-1))).alias("a")).first()
        took[hits] = time.perf_counter() - began
        assert row.u == "[" + ",".join(['{"a":{"k":0}}'] * hits) + "]" and row.d == "[" + ",".join(['{"a":{}}'] * hits) + "]"
        assert row.a == "[" + ",".join(['{"a":-1}'] * hits) + "]"
    assert took[64_000] < 8 * took[16_000] + 2


def test_nodes_as_rows(spark):
    rows = [(1, "x", '{"a":[1,{"b":"\\u0041"}],"a":null}'), (2, "y", None), (3, "z", "{"), (4, "z", "true"), (None, "z", "[]")]
    df = spark.createDataFrame(rows, "id int, tag string, doc string")
    got = n.json_nodes(df, ["id", "tag"], "doc").collect()
    first = [(r.node, r.parent, r.key, r.place, r.kind, r.depth, r.start, r.end, r.value, r.counts) for r in got if r.id == 1]
    assert first == [(0, None, None, None, "object", 0, 0, 33, None, True), (1, 0, "a", 0, "list", 1, 5, 23, None, False), (2, 1, None, 0, "number", 2, 6, 7, "1", False),
                     (3, 1, None, 1, "object", 2, 8, 22, None, False), (4, 3, "b", 0, "string", 3, 13, 21, "A", False), (5, 0, "a", 1, "null", 1, 28, 32, "null", True)]
    assert [(r.tag, r.kind) for r in got if r.id != 1] == [("z", "true"), ("z", "list")]
    assert n.json_nodes(df.where("id = 2"), "id", "doc").collect() == []


def test_a_long_chain_has_short_results(spark):
    """Paths are made for hits only: a chain of 200,000 containers has one."""
    deep = 100_000
    doc = '{"k":[' * deep + '{"z":1}' + "]}" * deep
    row = spark.createDataFrame([(doc,)], "doc string").select(n.lookup(F.col("doc"), "z").alias("z"), n.json_depth(F.col("doc")).alias("d")).first()
    assert row.d == 2 * deep + 1 and row.z[0].path == "/k/0" * deep + "/z" and row.z[0].value == "1"


def test_batches_are_read_in_small_parts():
    texts = pa.array(['{"a": "' + "x" * 1000 + '"}\n'] * 4000)
    parts = list(n._parts(texts))
    assert max(stop - start for start, stop in parts) * 1010 <= 1 << 20 and parts[0][0] == 0 and parts[-1][1] == 4000


def test_steps_of_an_edit_are_made_in_numpy_where_hits_lie_apart(monkeypatch):
    texts = ['{"id":1,"a":{"id":{"id":[1,{"id":3}]}},"b":[{"id":2}]}', '{"id":1,"x":{"id":2},"l":[{"id":[]},{"id":{}}]}', "{}", None, '{"id":', '{"id":"é","q":1}', "[]"]

    def steps(texts):
        index = JsonIndex(pa.array([None if t is None else t + "\n" for t in texts], pa.string()))
        hits = n.Keys(["id"]).hits(index)
        base = index.bounds[index.doc[hits]]
        return index, hits, list(zip((index.start[hits] - base).tolist(), (index.end[hits] - base).tolist()))

    index, hits, spans = steps(texts)
    at = [int(x) for x in np.searchsorted(index.doc[hits], np.arange(index.docs + 1))]
    want = [n._rounds(spans[a:b], int(size)) for a, b, size in zip(at, at[1:], np.diff(index.bounds) - 1)]
    assert n._steps(index, hits).to_pylist() == pa.array(want, n._STEPS).to_pylist()
    monkeypatch.setattr(n, "_rounds", None)  # not needed for the others
    index, hits, _ = steps(texts[1:])
    assert [x is None for x in n._steps(index, hits).to_pylist()] == [False, True, True, True, False, True]
