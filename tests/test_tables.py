import json
import os

import pytest
from pyspark.sql import functions as F

from tierstone.operators.scd import first_versions, refuse_late_load, scd2_changes
from tierstone.sources import bronze, tables


def test_versions_and_missing_tables(spark, base):
    assert not tables.table_exists(spark, base, "t")
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, base, "t")
    first = tables.write_table(spark.range(3), base, "t")
    second = tables.write_table(first.filter("id > 0"), base, "t")
    assert (first.count(), second.count()) == (3, 2)  # the older version is still readable
    assert tables.current_version(spark, base, "t").endswith("version=000002")


def test_incomplete_version_is_ignored(spark, base):
    tables.write_table(spark.range(3), base, "t")
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{base}/t/version=000002"
    )
    assert tables.read_table(spark, base, "t").count() == 3
    tables.write_table(spark.range(4), base, "t")
    assert tables.current_version(spark, base, "t").endswith("version=000003")


@pytest.fixture
def every_range(spark):
    """Keep the small ranges of a tiny test apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_hot_partition_is_written_by_several_tasks(spark, base, every_range):
    df = spark.range(4000).select("id", F.lit("hot").alias("p"), F.lit(1).alias("c"))
    tables.write_table(df, base, "t", ("p",), ("c",))
    got = tables.read_table(spark, base, "t")
    assert got.count() == 4000 and len(got.inputFiles()) > 1


def test_clusters_narrow_the_files(spark, base, every_range):
    df = spark.range(1000).select("id", F.pmod(F.xxhash64("id"), F.lit(50)).alias("c"))
    got = tables.write_table(df, base, "t", cluster_by=("c",))
    spans = got.groupBy(F.input_file_name().alias("f")).agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    edges = sorted((r.lo, r.hi) for r in spans.collect())
    assert len(edges) > 1 and all(a[1] <= b[0] for a, b in zip(edges, edges[1:]))


ROWS = [("r1", 2020, 1), ("r2", 2020, 1), ("r3", 2021, 1), ("r4", None, 1), ("r5", None, 1), ("r6", 2022, 1)]


def upserted(spark, base, updates):
    ddl = "k string, y int, v int"
    tables.write_table(spark.createDataFrame(ROWS, ddl), base, "t", ("y",), ("k",))
    before = {f.rsplit("/", 1)[1] for f in tables.read_table(spark, base, "t").inputFiles()}
    new = tables.write_table(spark.createDataFrame(updates, ddl), base, "u")
    got = tables.upsert_partitions(new, base, "t", "k", ("y",), ("k",))
    after = {f.rsplit("/", 1)[1] for f in got.inputFiles()}
    return sorted(((r.k, r.y, r.v) for r in got.collect()), key=str), before & after


def expected(updates):
    merged = {k: (k, y, v) for k, y, v in ROWS} | {k: (k, y, v) for k, y, v in updates}
    return sorted(merged.values(), key=str)


def test_upsert_rewrites_only_touched_partitions(spark, base):
    updates = [("r1", 2020, 2), ("r4", None, 2), ("r7", 2020, 2)]
    got, kept = upserted(spark, base, updates)
    assert got == expected(updates)
    assert kept  # files of 2021 and 2022 are still the old ones
    assert tables.current_version(spark, base, "t").endswith("version=000001")


def test_upsert_moves_rows_between_partitions(spark, base):
    updates = [("r1", 2021, 2), ("r5", 2020, 2)]
    got, _ = upserted(spark, base, updates)
    assert got == expected(updates)


def test_upsert_that_empties_a_partition(spark, base):
    updates = [("r6", 2020, 2)]
    got, _ = upserted(spark, base, updates)
    assert got == expected(updates)
    assert tables.current_version(spark, base, "t").endswith("version=000001")
    assert tables.read_table(spark, base, "t").filter("y = 2022").isEmpty()


def test_upsert_with_a_new_column(spark, base):
    tables.write_table(spark.createDataFrame(ROWS, "k string, y int, v int"), base, "t", ("y",))
    new = tables.write_table(spark.createDataFrame([("r1", 2020, 2, "x")], "k string, y int, v int, more string"), base, "u")
    got = tables.upsert_partitions(new, base, "t", "k", ("y",))
    assert {(r.k, r.more) for r in got.collect()} == {("r1", "x")} | {(f"r{i}", None) for i in range(2, 7)}


def test_partitioned_table_without_rows(spark, base):
    empty = spark.createDataFrame([], "k string, y int, v int")
    got = tables.write_table(empty, base, "t", ("y",))
    assert got.collect() == [] and dict(got.dtypes) == dict(empty.dtypes)
    new = tables.write_table(spark.createDataFrame(ROWS, "k string, y int, v int"), base, "u")
    assert tables.upsert_partitions(new, base, "t", "k", ("y",)).count() == len(ROWS)


def test_partition_values_keep_their_type(spark, base):
    rows = spark.createDataFrame([("a", "01"), ("b", "1"), ("c", "a b:c/ä"), ("d", None)], "k string, p string")
    got = tables.write_table(rows, base, "t", ("p",))
    assert {tuple(r) for r in got.select("k", "p").collect()} == {tuple(r) for r in rows.collect()}
    moved = tables.write_table(spark.createDataFrame([("c", "01")], "k string, p string"), base, "u")
    got = tables.upsert_partitions(moved, base, "t", "k", ("p",))
    assert {(r.k, r.p) for r in got.collect()} == {("a", "01"), ("b", "1"), ("c", "01"), ("d", None)}


def test_history_is_written_once(spark, base):
    times = [f"20{y}-01-01 00:00:00" for y in range(20, 24)]
    table = None
    closed = []
    for n, ts in enumerate(times):
        snap = spark.createDataFrame([("a", "01", str(n)), ("b", "02", "same")], "k string, state string, change_hash string")
        changes = first_versions(snap, ts, None) if table is None else scd2_changes(table, snap, "k", ts, None)
        table = tables.write_versions(changes, base, "t", ("state",))
        files = {f: os.path.getmtime(f.removeprefix("file://")) for f in table.filter("not is_current").inputFiles() if "is_current=false" in f}
        closed.append(files)
    assert all(set(a.items()) <= set(b.items()) for a, b in zip(closed, closed[1:])) and len(closed[-1]) >= 3
    rows = sorted((r.k, r.state, r.change_hash, str(r.valid_from)[:4], str(r.valid_to)[:4], r.is_current) for r in table.collect())
    assert rows == [
        ("a", "01", "0", "2020", "2021", False), ("a", "01", "1", "2021", "2022", False), ("a", "01", "2", "2022", "2023", False),
        ("a", "01", "3", "2023", "9999", True), ("b", "02", "same", "2020", "9999", True),
    ]
    tables.drop_old_versions(spark, base, "t", keep=1)
    assert tables.read_table(spark, base, "t").count() == 5
    with pytest.raises(ValueError):
        refuse_late_load(table, "2022-06-01 00:00:00")
    refuse_late_load(table, "2023-01-01 00:00:00")  # the same load again
    anew = tables.write_versions(first_versions(snap, times[-1], None), base, "t", ("state",), keep_history=False)
    assert anew.count() == 2


def test_old_versions_can_be_dropped(spark, base):
    for n in (1, 2, 3):
        tables.write_table(spark.range(n), base, "t")
    tables.drop_old_versions(spark, base, "t", keep=2)
    assert sorted(p for p in os.listdir(f"{base}/t") if p.startswith("version=")) == ["version=000002", "version=000003"]
    assert tables.read_table(spark, base, "t").count() == 3


def test_quarantine_reruns_replace_and_runs_accumulate(spark, base):
    tables.append_quarantine(spark.range(3), base, "e", "run-1")
    tables.append_quarantine(spark.range(2), base, "e", "run-1")
    tables.append_quarantine(spark.range(4).withColumn("why", F.lit("x")), base, "e", "run-2")
    counts = {r.run_id: r["count"] for r in tables.read_quarantine(spark, base, "e").groupBy("run_id").count().collect()}
    assert counts == {"run-1": 2, "run-2": 4}
    assert tables.read_quarantine(spark, base, "e", "run-1").count() == 2


def test_log_schema_grows(spark, base):
    tables.append_log(spark.createDataFrame([("a", 1)], "s string, n int"), base, "1")
    tables.append_log(spark.createDataFrame([("a", 1, 2.0)], "s string, n int, m double"), base, "2")
    log = tables.read_log(spark, base)
    assert set(log.columns) == {"s", "n", "m"} and log.count() == 2


def test_bronze_schema_missing_fields_and_bad_lines(spark, tmp_path):
    lines = [json.dumps({"user_id": "u1", "joined_on": "2011-01-01", "elite": ["2012"]}), "{broken", "{}"]
    (tmp_path / "user.json").write_text("\n".join(lines))
    df = bronze.read_bronze(spark, str(tmp_path), "user", {"joined_on": "member_since"}, keep_corrupt=True)
    rows = df.select("user_id", "member_since", "fans", "_corrupt_record").collect()
    assert tuple(rows[0]) == ("u1", "2011-01-01", None, None)
    assert rows[1]._corrupt_record == "{broken" and rows[2].user_id is None
    with pytest.raises(ValueError):
        bronze.read_bronze(spark, str(tmp_path), "user", {"joined_on": "no_such_field"})
    plain = bronze.read_bronze(spark, str(tmp_path), "user", {"joined_on": "member_since"})
    assert "member_since" in plain.columns and plain.count() == 3


def test_tallies_count_what_is_written(spark, base):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 11).alias("b"))
    for n, options in enumerate(({}, {"partition_by": ("a",)}, {"cluster_by": ("a",)}, {"cluster_by": ("a", "b"), "curve": True})):
        tally = tables.Tally(rows=F.count("*"), even=F.count_if(F.col("id") % 2 == 0), total=F.sum("id"))
        tables.write_table(df, base, f"t{n}", tally=tally, **options)
        assert (tally["rows"], tally["even"], tally["total"]) == (1000, 500, 499500)
    for empty in (df.limit(0), spark.createDataFrame([], "id long"), df.filter("id < 0")):
        tally = tables.Tally(rows=F.count("*"), total=F.sum("id"))
        tables.write_table(empty, base, "none", tally=tally)
        assert (tally["rows"], tally["total"]) == (0, 0)
    tally = tables.Tally(rows=F.count("*"))
    tables.append_quarantine(df.filter("a = 1"), base, "x", "run", tally)
    assert tally["rows"] == 143
