"""Mergeable distinct counts, schema drift, long packed strings, the model graph."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tierstone.operators.distinct import BITS, distinct_counts, distinct_partials, merge_partials, number_keys
from tierstone.operators.nested import explode_events, explode_wide_events
from tierstone.plans.pipeline import Catalog
from tierstone.sources.bronze import EXTRA, drift_report, read_bronze
from tierstone.sources.tables import write_table


def test_counts_from_merged_bitmaps_are_exact(spark, base):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), 2000 + i % 3, i % 12, rng.choice([None, *range(40)]) if rng.random() < 0.3 else rng.randrange(90_000)) for i in range(6000)]
    events = spark.createDataFrame(rows, "g string, y int, m int, k long")
    ids = write_table(number_keys(events.filter("y = 2000"), "k"), base, "ids")
    more = write_table(number_keys(events, "k", ids), base, "more")
    every = ids.unionByName(more)
    assert every.count() == every.select("id").distinct().count() == events.filter("k is not null").select("k").distinct().count()
    assert more.agg(F.min("id")).first()[0] // BITS > ids.agg(F.max("id")).first()[0] // BITS
    monthly = write_table(distinct_partials(events.join(every, "k", "left"), ["g", "y", "m"]), base, "monthly")
    for groups in (["g", "y", "m"], ["g", "y"], ["g"], ["y"]):
        got = {tuple(r[c] for c in groups): r.distinct_count for r in distinct_counts(monthly, groups).collect()}
        want = {tuple(r[c] for c in groups): r.n for r in events.groupBy(*groups).agg(F.count_distinct("k").alias("n")).collect()}
        assert got == want
    yearly = merge_partials(monthly, ["g", "y"])
    assert sorted(distinct_counts(yearly, ["g"]).collect()) == sorted(distinct_counts(monthly, ["g"]).collect())
    plan = distinct_counts(monthly, ["g", "y"])._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan and plan.count("FileScan") == 1  # the stored months alone are read


def test_no_keys_and_no_events(spark, base):
    none = spark.createDataFrame([], "g string, k long")
    ids = write_table(number_keys(none, "k"), base, "ids")
    assert number_keys(spark.createDataFrame([("a", 5)], "g string, k long"), "k", ids).count() == 1
    assert distinct_counts(distinct_partials(none.join(ids, "k"), ["g"]), ["g"]).collect() == []


LINES = [
    {"business_id": "b", "date": "x"},
    {"business_id": "b", "date": "y", "new": 5, "deep": {"a": [1, 2], "b": None}},
    {"business_id": "c", "date": None, "new": "five", "Business_ID": "other case"},
    {"business_id": None, "date": "z", "nothing": None},
]


def write_lines(folder, lines):
    folder.mkdir()
    (folder / "checkin.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(folder)


def test_undeclared_fields_come_back_row_by_row(spark, tmp_path):
    folder = write_lines(tmp_path / "a", [*LINES, "no json", "", "[1]"])
    plain = read_bronze(spark, folder, "checkin", keep_corrupt=True)
    wide = read_bronze(spark, folder, "checkin", keep_corrupt=True, keep_extra=True)
    assert wide.columns == [*plain.columns, EXTRA]
    assert sorted(map(str, wide.drop(EXTRA).collect())) == sorted(map(str, plain.collect()))
    extra = [json.loads(r.x) for r in wide.select(F.to_json(EXTRA).alias("x")).filter("x is not null").collect()]
    known = {"business_id", "date"}
    want = [{k: v for k, v in line.items() if k not in known} for line in LINES if set(line) - known]
    by_text = lambda rows: sorted(json.dumps(r, sort_keys=True) for r in rows)
    assert by_text(extra) == by_text(want)
    report = {r.field: (r.entity, r.row_count, r.type) for r in drift_report(wide, "checkin").collect()}
    assert report == {
        "new": ("checkin", 2, "VARIANT"), "deep": ("checkin", 1, "OBJECT<a: ARRAY<BIGINT>, b: VOID>"),
        "Business_ID": ("checkin", 1, "STRING"), "nothing": ("checkin", 1, "VOID"),
    }
    write_table(wide, str(tmp_path / "lake"), "raw")  # a VARIANT column is stored like any other


def test_no_drift_where_all_fields_are_declared(spark, tmp_path):
    wide = read_bronze(spark, write_lines(tmp_path / "a", LINES[:1]), "checkin", keep_extra=True)
    assert wide.filter(F.col(EXTRA).isNotNull()).isEmpty() and drift_report(wide, "checkin").isEmpty()


def test_renamed_fields_are_no_drift(spark, tmp_path):
    wide = read_bronze(spark, write_lines(tmp_path / "a", [{"business_id": "b", "stamps": "s"}]), "checkin", {"stamps": "date"}, keep_extra=True)
    assert [(r.business_id, r.date) for r in wide.filter(F.col(EXTRA).isNull()).collect()] == [("b", "s")]


@pytest.mark.parametrize("chunk", [1, 7, 50, 10**6])
@pytest.mark.parametrize("separator", [",", "|", "x"])
def test_long_strings_explode_as_short_ones(spark, chunk, separator):
    rng = random.Random(chunk)
    texts = [None, "", separator, f" {separator} é ", "one", f"a{separator}b", f"a\nb{separator}c{separator}"]
    texts += [separator.join(rng.choice(["", " ", "é" * rng.randint(1, 9), f" t{k} "]) for k in range(rng.randint(1, 60))) for _ in range(15)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, packed string")
    mark = "\\" + separator if separator == "|" else separator
    want = explode_events(df, ["k"], "packed", "item", "total", "place", mark)
    got = explode_wide_events(df, ["k"], "packed", "item", "total", "place", separator, chunk)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_long_line_is_exploded_by_several_tasks(spark):
    n, rng = 200_000, random.Random(1)
    df = spark.createDataFrame([("a", ", ".join(f"{rng.getrandbits(60):x}" for _ in range(n)))], "k string, packed string")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        got = explode_wide_events(df, ["k"], "packed", "stamp", "total", "place", chunk_chars=20_000)
        tasks = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sum(r["count"] for r in tasks) == n and len(tasks) > 1
    assert got.agg(F.count_distinct("place"), F.max("place"), F.min("total")).first() == (n, n - 1, n)
    with pytest.raises(ValueError):
        explode_wide_events(df, ["k"], "packed", "stamp", "total", "place", ", ")


def test_models_are_ordered_by_what_they_ask_for(spark, base):
    catalog = Catalog(spark, base)
    catalog.save("raw", spark.range(5))
    catalog.define("c", lambda c: c.table("b").union(c.table("a")))
    catalog.define("b", lambda c: c.table("a").filter("id > 1"))
    catalog.define("a", lambda c: c.table("raw"))
    catalog.define("apart", lambda c: spark.range(1))
    assert catalog.inputs() == {"c": ["b", "a"], "b": ["a"], "a": ["raw"], "apart": []}
    assert catalog.levels() == {"c": 2, "b": 1, "a": 0, "apart": 0}
    assert catalog.order() == ["a", "apart", "b", "c"]
    assert catalog.downstream("raw") == ["a", "b", "c"] and catalog.downstream("b") == ["c"] and catalog.downstream("apart") == []
    for name in catalog.order():
        catalog.build(name)
    catalog.save("raw", spark.range(7))
    assert catalog.table("c").count() == 8  # as built
    assert catalog.rebuild("raw") == ["a", "b", "c"] and catalog.table("c").count() == 12


def test_models_that_need_each_other_are_refused(spark, base):
    catalog = Catalog(spark, base)
    catalog.define("a", lambda c: c.table("b"))
    catalog.define("b", lambda c: c.table("c"))
    catalog.define("c", lambda c: c.table("a"))
    with pytest.raises(ValueError, match="a -> b -> c -> a"):
        catalog.order()
    catalog.save("c", spark.range(1))  # a written table ends the search, but not the circle
    with pytest.raises(ValueError, match="need each other"):
        catalog.order()


def test_named_models_take_the_stored_histories(monkeypatch):
    """The reviews look their keys up in the stored versions, so computing them again for the catalog is a second run."""
    from types import SimpleNamespace

    from tierstone.workload import queries

    saved = {}
    fake = SimpleNamespace(save=saved.__setitem__, build=lambda name: None, table=lambda name: name)
    monkeypatch.setattr(queries, "Catalog", lambda spark, base: fake)
    monkeypatch.setattr(queries, "define_gold", lambda catalog: None)
    names = ("business", "users", "reviews", "tips")
    f = SimpleNamespace(spark=None, scratch=lambda: "base", **{n: (lambda n=n: f"stored {n}") for n in names})
    assert queries.catalog_names(f) == "gold/agg_business_monthly"
    assert saved == {f"silver/{n}": f"stored {n}" for n in names}
