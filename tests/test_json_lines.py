"""JSON lines that queries write and read back: compressed, the same rows."""

from types import SimpleNamespace

from tierstone.workload import queries

REVIEW = "review_id string, business_id string, user_id string, stars double, useful int, funny int, cool int, text string, date string"
ROWS = [
    ("7-1", "b", "u", 1.5, 9, 1, None, "A\n" * 20, "1995-01-02 00:00:00"),
    ("7-2", None, "u", 2.5, 0, 2, 1, "", "1995-01-03 00:00:00"),
    ("7-3", "b", None, None, 0, 2, 2, None, None),
    ("7-3", "b", None, None, 0, 2, 2, None, None),
]


def frames(spark, base):
    rows = spark.createDataFrame(ROWS, REVIEW)
    return SimpleNamespace(spark=spark, scratch=lambda: base, bronze_reviews=lambda: rows)


def packed(df):
    files = df.inputFiles()
    return bool(files) and all(f.endswith(".gz") for f in files)


def test_lines_come_back_from_compressed_files(spark, base):
    f = frames(spark, base)
    back = queries._as_json(f, "review", f.bronze_reviews())
    assert packed(back) and sorted(map(str, back.collect())) == sorted(map(str, f.bronze_reviews().collect()))


def test_undeclared_fields_come_back_from_compressed_files(spark, base):
    found = queries.json_extra_fields(frames(spark, base))
    assert packed(found)
    extra = {(r.review_id, r.boosts, r.device_level, r.device_via, r.grade) for r in found.collect()}
    assert extra == {("7-1", 90.0, 1.0, "web", None), ("7-2", None, None, None, "two"), ("7-3", None, None, None, "3")}
