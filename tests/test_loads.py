"""Guarded loads, ranks and keys without one task, landings and integrity."""

import json
import os

import pytest
from pyspark.sql import functions as F

from gridstone.operators import quality, ranks, views
from gridstone.operators.relations import Grain, Relation, integrity
from gridstone.sources import landing, promotion
from gridstone.sources.datasets import Dataset, Registry, build_views, relations_of, view_order


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k long, v double, day string")


CHECKS = promotion.RowChecks(("k", "v"), (("v", 0, 10),), most_null=0.2, time="day", as_of="2024-01-10", most_days=30)


def table(spark, tmp_path):
    return promotion.VersionedTable(spark, f"{tmp_path}/facts")


def no_duplicates(staged):
    return quality.duplicate_rate(staged, ["k"])


def test_a_failing_check_leaves_the_old_version(spark, tmp_path):
    t = table(spark, tmp_path)
    found = promotion.guarded_write(keyed(spark, [(1, 1.0, "2024-01-01"), (2, 0.0, None)]), t, CHECKS, no_duplicates)
    assert {r["name"]: r["status"] for r in found.collect()} == {"null_rate": "PASS", "range_v": "PASS", "schema": "PASS", "freshness": "PASS", "duplicate_rate": "PASS"}
    bad = {
        "range_v": [(1, -1.0, "2024-01-01")],
        "null_rate": [(1, None, "2024-01-01"), (2, 1.0, None)],
        "duplicate_rate": [(1, 1.0, "2024-01-01"), (1, 2.0, "2024-01-01")],
    }
    for name, rows in bad.items():
        with pytest.raises(promotion.Blocked, match=name) as e:
            promotion.guarded_write(keyed(spark, rows), t, CHECKS, no_duplicates)
        assert [r["name"] for r in e.value.results.where("status = 'FAIL'").collect()] == [name]
        assert sorted(r.k for r in t.read().collect()) == [1, 2] and len(t.history()) == 1
    with pytest.raises(promotion.Blocked, match="schema"):
        promotion.guarded_write(spark.createDataFrame([(1,)], "k long"), t, CHECKS)
    with pytest.raises(promotion.Blocked, match="null_rate"):  # an empty table never passes
        promotion.guarded_write(keyed(spark, []), t, CHECKS)
    assert t.files.names(f"{t.folder}/versions") == [t.history()[0].id]


def test_reports_without_blocking_when_not_strict(spark, tmp_path):
    t = table(spark, tmp_path)
    found = promotion.guarded_write(keyed(spark, [(1, -1.0, "2020-01-01")]), t, CHECKS, strict=False)
    assert {r["name"] for r in found.where("status = 'FAIL'").collect()} == {"range_v", "freshness"}
    assert [(v.number, v.rows) for v in t.history()] == [(1, 1)]


def test_a_write_that_dies_leaves_the_old_version(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        t.read()
    promotion.guarded_write(keyed(spark, [(1, 1.0, None)]), t, CHECKS)
    dies = keyed(spark, [(2, 2.0, None)]).withColumn("v", F.raise_error(F.lit("executor lost")).cast("double"))
    with pytest.raises(Exception, match="executor lost"):
        promotion.guarded_write(dies, t, CHECKS)
    assert [r.k for r in t.read().collect()] == [1]
    t.vacuum()
    assert t.files.names(f"{t.folder}/versions") == [t.history()[0].id] and [r.k for r in t.read().collect()] == [1]


def test_two_promotions_at_once(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    promotion.guarded_write(keyed(spark, [(1, 1.0, None)]), t, CHECKS)
    late = t.history()
    promotion.guarded_write(keyed(spark, [(2, 2.0, None)]), other, CHECKS)
    monkeypatch.setattr(promotion.VersionedTable, "history", lambda self: late)
    with pytest.raises(FileExistsError):
        promotion.guarded_write(keyed(spark, [(3, 3.0, None)]), t, CHECKS)
    monkeypatch.undo()
    assert [r.k for r in t.read().collect()] == [2] and [r.k for r in t.read(1).collect()] == [1]
    assert len(t.vacuum(keep=1)) == 2 and [v.number for v in t.history()] == [2]


def test_the_source_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = keyed(spark, [(i, 1.0, None) for i in range(100)]).repartition(4).mapInArrow(counted, "k long, v double, day string")
    promotion.guarded_write(rows, table(spark, tmp_path), CHECKS, no_duplicates)
    assert seen.value == 100


# --- ranks and keys -----------------------------------------------------------------------------------------------


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 3, 7, 500])
def test_positions_equal_windows_over_all_rows(spark, n):
    rows = [(i, None if i % 11 == 5 else float(i * 37 % 13), "hot" if i % 3 else f"s{i % 7}") for i in range(n)]
    df = spark.createDataFrame(rows, "i long, x double, s string").repartition(5)
    order = [ranks.By("x", True), "i"]
    want = df.selectExpr("*", "row_number() over (order by x desc nulls last, i) as p", "ntile(4) over (order by x desc nulls last, i) as q", "rank() over (order by s, x desc nulls last) as r", "dense_rank() over (order by s, x desc nulls last) as e")
    got = ranks.value_ranks(ranks.ntile(ranks.positions(df, order, "p"), order, 4, "q"), ["s", order[0]], "r", "e").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "SinglePartition" not in plan_of(got) and "SinglePartition" in plan_of(want)


def test_sketch_tiles_are_near_exact_ones(spark):
    df = spark.range(20_000).select(F.col("id").alias("i"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("x"))
    both = ranks.sketch_tile(ranks.ntile(df, ["x", "i"], 10, "exact"), "x", 10, "near", accuracy=1000)
    assert both.where("exact <> near").count() <= 20_000 * 9 / 1000
    assert both.where("abs(exact - near) > 1").count() == 0
    assert ranks.sketch_tile(spark.createDataFrame([(None,), (1.0,)], "x double"), "x", 4, "t").where("x is null and t is null").count() == 1


def test_quartiles_of_regions_without_one_task(spark):
    regional = spark.createDataFrame([(f"r{i}", 2020, float(i)) for i in range(10)], "region_code string, year int, measure_value double")
    people = spark.createDataFrame([(f"r{i}", 1000.0) for i in range(10)], "region_code string, population double")
    risk = views.regional_risk(regional, people)
    assert "SinglePartition" not in plan_of(risk)
    assert {r.region_code: r.density_quartile for r in risk.collect()} == {f"r{i}": q for i, q in enumerate([1, 1, 1, 2, 2, 2, 3, 3, 4, 4])}


def test_keys_stay_when_codes_are_added(spark):
    codes = lambda *c: spark.createDataFrame([(x,) for x in c], "code string")
    keys = lambda df: {r.code: r.key for r in df.collect()}
    first = ranks.stable_keys(codes("b", "d", "b", None), "code", "key")
    assert keys(first) == {"b": 1, "d": 2}
    second = ranks.stable_keys(codes("a", "c", "d"), "code", "key", first)
    assert keys(second) == {"b": 1, "d": 2, "a": 3, "c": 4}
    assert keys(ranks.stable_keys(codes(), "code", "key", second)) == keys(second)
    assert keys(ranks.stable_keys(codes("z"), "code", "key", codes().selectExpr("code", "1L as key"), start=100)) == {"z": 100}


# --- landings -----------------------------------------------------------------------------------------------------


def cube(geo, *values):
    codes = [f"a{i}" for i in range(len(values))]
    index = lambda c: {"category": {"index": {x: i for i, x in enumerate(c)}}}
    return json.dumps({"id": ["geo", "age"], "size": [1, len(codes)], "dimension": {"geo": index([geo]), "age": index(codes)}, "value": {str(i): v for i, v in enumerate(values)}})


def test_landings_decode_only_what_changed(spark, tmp_path):
    inbox = tmp_path / "inbox"
    put = lambda name, text: ((inbox / name).parent.mkdir(parents=True, exist_ok=True), (inbox / name).write_text(text))
    registry = Registry().add("one", Dataset("one", "One", ("geo", "age"))).add("two", Dataset("two", "Two", ("geo", "age"))).add("none", Dataset("none", "None", ("geo",)))
    taken = landing.Landing(spark, f"{tmp_path}/landed", registry)
    for name, text in {"one/DE.json": cube("DE", 1, 2), "one/FR.json": cube("FR", 3, ":"), "one/IT.json": cube("IT", ":"), "one/bad.json": "{no", "two/DE.json": cube("DE", 9), "odd/x.json": cube("X", 1)}.items():
        put(name, text)
    state = lambda: {r.file.split("/inbox/")[1]: (r.status, r.rows, r.landing) for r in taken.manifest().collect()}
    rows = lambda name: {(r.geo, r.age, r.value, r.landing) for r in taken.rows(name).collect()}
    assert taken.rows("one").collect() == []
    assert taken.land(f"file:{inbox}", ["one/DE.json", "one/ES.json"]) == landing.Report(6, 6, 4, 0)
    first = {"one/DE.json": ("OK", 2, 1), "one/FR.json": ("OK", 1, 1), "one/IT.json": ("EMPTY", 0, 1), "one/bad.json": ("BADJSON", 0, 1), "two/DE.json": ("OK", 1, 1), "odd/x.json": ("FAIL", 0, 1), "one/ES.json": ("FAIL", 0, 1)}
    assert state() == first
    put("one/FR.json", cube("FR", 7, 8))
    put("one/ES.json", cube("ES", 5))
    os.utime(inbox / "two/DE.json", (1, 1))  # another time, the same bytes
    os.remove(inbox / "one/DE.json")
    # a file of an unknown dataset is looked at again each time, as its dataset may be known by then
    assert taken.land(f"file:{inbox}") == landing.Report(6, 4, 2, 1)
    changed = {"one/FR.json": ("OK", 2, 2), "one/ES.json": ("OK", 1, 2), "odd/x.json": ("FAIL", 0, 2)}
    assert state() == {k: v for k, v in (first | changed).items() if k != "one/DE.json"}
    assert rows("one") == {("FR", "a0", 7.0, 2), ("FR", "a1", 8.0, 2), ("ES", "a0", 5.0, 2)} and rows("two") == {("DE", "a0", 9.0, 1)}
    assert taken.land(f"file:{inbox}").decoded == 0 and rows("one") == {("FR", "a0", 7.0, 2), ("FR", "a1", 8.0, 2), ("ES", "a0", 5.0, 2)}
    assert {(r.dataset_code, r.files, r.rows, r.status) for r in taken.report().collect()} == {("one", 4, 3, "OK"), ("two", 1, 1, "OK"), ("odd", 1, 0, "FAIL"), ("none", 0, 0, "EMPTY")}
    assert [(r.geo, r.dataset_label) for r in taken.rows("one", ["ES"]).collect()] == [("ES", "One")]


def test_published_datasets():
    known = landing.published().known
    assert len(known) == 23 and all(d.dims[0] == "freq" and d.dims[-2:] == ("geo", "time") for d in known.values())
    assert known["hospital_days"].since == "2015" and known["projections"].since is None
    with pytest.raises(ValueError, match="not a published"):
        landing.published().add("x", Dataset("hlth_care", "x", ("geo",)))


# --- integrity ----------------------------------------------------------------------------------------------------


def test_integrity_from_declarations(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(1, "a", 2020), (1, "a", 2020), (2, None, 2020), (9, "z", None), (9, "z", None), (3, "null", 2021)]
    fact = spark.createDataFrame(rows, "id long, code string, year int").mapInArrow(counted, "id long, code string, year int")
    tables = {"fact": fact, "ids": spark.createDataFrame([("1",), ("2",), ("3",), ("3",)], "id string"), "codes": spark.createDataFrame([("a",), ("z",)], "code string"), "empty": spark.createDataFrame([], "id long")}
    checks = [Relation("fact", "id", "ids", "id"), Relation("fact", "code", "codes", "code"), Relation("fact", "year", "empty", "id", active=False), Grain("fact", ("id", "code", "year")), Grain("fact", ("id", "nothing")), Relation("fact", "gone", "codes", "code"), Relation("fact", "id", "absent", "id"), Relation("empty", "id", "ids", "id"), Grain("empty", ("id",))]
    got = {r["check"]: (r["kind"], r["status"], r["rows"], r["bad"], r["detail"]) for r in integrity(tables, checks).collect()}
    assert got == {
        "fact.id -> ids.id": ("relation", "FAIL", 6, 2, "9"),
        "fact.code -> codes.code": ("relation", "FAIL", 6, 1, "null"),
        "fact.year -> empty.id": ("relation", "FAIL", 6, 4, "2020"),
        "fact by id, code, year": ("grain", "FAIL", 6, 2, '{"id":1,"code":"a","year":2020}'),
        "fact by id, nothing": ("grain", "UNBOUND", None, None, "no fact.nothing"),
        "fact.gone -> codes.code": ("relation", "UNBOUND", None, None, "no fact.gone"),
        "fact.id -> absent.id": ("relation", "UNBOUND", None, None, "no absent"),
        "empty.id -> ids.id": ("relation", "OK", 0, 0, None),
        "empty by id": ("grain", "OK", 0, 0, None),
    }
    assert seen.value == len(rows)  # four checks, one pass


def test_integrity_reads_a_dimension_once_and_apart_changes_nothing(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    fact = spark.createDataFrame([(1, 1, "1", None), (1, 2, "x", 7), (1, 2, "x", 7), (None, 9, None, 7), (None, 9, "1", 7)], "a long, b int, c string, d long")
    ids = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int").mapInArrow(counted, "id int")
    checks = [Relation("fact", "a", "ids", "id"), Relation("fact", "b", "ids", "id"), Relation("fact", "c", "ids", "id"), Relation("fact", "b", "texts", "id"), Grain("fact", ("b",)), Grain("fact", ("a", "b")), Grain("fact", ("b", "a")), Grain("fact", ("a", "d", "c"))]
    tables = {"fact": fact, "ids": ids, "texts": spark.createDataFrame([("1",), ("9",)], "id string")}
    want = [
        ("fact.a -> ids.id", 0, None), ("fact.b -> ids.id", 2, "9"), ("fact.c -> ids.id", 2, "x"), ("fact.b -> texts.id", 2, "2"), ("fact by b", 2, '{"b":2}'), ("fact by a, b", 2, '{"a":1,"b":2}'),
        ("fact by b, a", 2, '{"b":2,"a":1}'), ("fact by a, d, c", 1, '{"a":1,"d":7,"c":"x"}'),
    ]
    got = lambda **more: sorted(tuple(r) for r in integrity(tables, checks, **more).select("check", "rows", "bad", "detail").collect())
    assert got() == sorted((name, 5, bad, detail) for name, bad, detail in want)
    assert seen.value == 4  # three relations to it
    assert got(apart=["fact"]) == got()


def test_all_relations_read_their_tables_a_few_times(spark, monkeypatch):
    from __spark_entry__ import SMOKE_DIR
    from gridstone.plans import adapter, loads

    seen, plain = {n: spark.sparkContext.accumulator(0) for n in ("orders", "lineitem", "customer")}, adapter.read

    def read(session, d, name):
        df = plain(session, d, name)
        if name not in seen:
            return df

        def counted(batches):
            for batch in batches:
                seen[name].add(batch.num_rows)
                yield batch

        return df.mapInArrow(counted, df.schema)

    monkeypatch.setattr(adapter, "read", read)
    assert loads.all_relations(spark, SMOKE_DIR).count() == len(loads.CHECKS)
    passes = {n: a.value / plain(spark, SMOKE_DIR, n).count() for n, a in seen.items()}
    assert passes["customer"] <= 3 and passes["orders"] <= 5 and passes["lineitem"] <= 7, passes  # lines: workers, beds, sexes and their four checks


# --- views --------------------------------------------------------------------------------------------------------


def test_views_in_any_order(spark):
    views = {
        "w_c": "select x + 1 as x from w_b where x in (select x from w_a) and exists (select 1 from w_d)",
        "w_b": "with t as (select * from w_a) select * from t",
        "w_d": "select 1 as y union all select x from w_a",
        "w_a": lambda s: s.range(3).selectExpr("id as x"),
    }
    assert relations_of(spark, views["w_c"]) == {"w_a", "w_b", "w_d"} and relations_of(spark, "select * from db.t join u") == {"db.t", "u"}
    for order in (list(views), list(views)[::-1]):
        built = build_views(spark, {n: views[n] for n in order})
        assert built.index("w_a") < built.index("w_b") < built.index("w_c") and built.index("w_d") < built.index("w_c")
        assert sorted(r.x for r in spark.table("w_c").collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="w_x -> w_y -> w_z -> w_x"):
        view_order(spark, {"w_x": "select * from w_y", "w_y": "select * from w_z, w_a", "w_z": "select * from w_x", "w_a": "select 1"})
    with pytest.raises(ValueError, match="w_s -> w_s"):
        view_order(spark, {"w_s": "select * from w_s"})
    with pytest.raises(ValueError, match="w_bad.*nothing_here"):
        build_views(spark, {"w_bad": "select * from nothing_here", "w_good": "select 1 as a"})
