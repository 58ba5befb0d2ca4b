"""Two loads end to end on generated bronze files, the second with changes."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from tierstone.plans.pipeline import Catalog, define_gold, run_pipeline, run_silver
from tierstone.sources.tables import read_log, read_quarantine, write_table
from tierstone.streaming.reviews import stream_reviews

LOADS = ("2020-01-01 00:00:00", "2021-01-01 00:00:00")


def businesses(load):
    rows = []
    for i in range(6):
        rows.append(
            {"business_id": f"b{i}", "name": f"Shop {i}", "city": f"c{i // 3}", "state": "S", "latitude": 1.0,
             "longitude": 2.0, "stars": 3.5 + (0.5 if load and i == 0 else 0), "review_count": 60, "is_open": 1,
             "categories": "Food, Bars, Food" if i else None, "hours": {"Monday": "9:0-17:0", "Sunday": "10:0-12:0"},
             "attributes": {"RestaurantsPriceRange2": "2", "WiFi": "u'free'", "RestaurantsDelivery": "True"}}
        )
    rows.append({**rows[0], "business_id": "bad", "latitude": None})
    return rows


def users(load):
    return [
        {"user_id": f"u{i}", "name": f"U{i}", "member_since": "2015-02-03", "review_count": 30 * i + (5 if load else 0),
         "average_stars": 3.0, "fans": 60, "friends": ["x"], "elite": ["2016", "2019"] if i == 1 else None}
        for i in range(5)
    ] + [{"user_id": "nameless", "member_since": "2015-02-03"}]


def reviews(load):
    rows = [
        {"review_id": f"r{i}", "business_id": f"b{i % 6}", "user_id": f"u{i % 5}", "stars": 1.0 + i % 5, "useful": i,
         "text": "word " * (40 + i), "date": f"201{6 + i % 4}-0{1 + i % 9}-15"}
        for i in range(60)
    ]
    rows.append({**rows[3], "date": "2019-12-31", "stars": 5.0})  # resubmitted
    rows += [
        {**rows[0], "review_id": "o1", "business_id": "bad"},
        {**rows[0], "review_id": "o2", "user_id": "ghost"},
        {**rows[0], "review_id": "s1", "stars": 9.0},
        {**rows[0], "review_id": "e1", "text": " \n "},
        {**rows[0], "review_id": None},
    ]
    if load:
        rows = [{**r, "date": "2020-06-01"} for r in rows[:10]] + [{**rows[0], "review_id": "new", "date": "2020-07-01"}]
    return rows


def write_bronze(folder, load):
    folder.mkdir(exist_ok=True)
    files = {
        "business": businesses(load),
        "user": users(load),
        "review": reviews(load),
        "checkin": [{"business_id": "b1", "date": "2016-04-26 19:49:16, 2017-08-30 18:36:57, rubbish"},
                    {"business_id": "b2", "date": "2018-01-06 11:00:00, 2018-01-06 11:00:00"},
                    {"business_id": "b3", "date": None}],
        "tip": [{"business_id": "b1", "user_id": "u1", "text": "go early", "date": "2017-03-04 10:00:00",
                 "compliment_count": 6},
                {"business_id": "b1", "user_id": "u1", "text": "go late", "date": "2017-03-04 20:00:00"},
                {"business_id": "b9", "user_id": "u1", "text": "x", "date": "2017-03-04"}],
        "photo": [{"photo_id": "p1", "business_id": "b1", "caption": None, "label": " Food "},
                  {"photo_id": "p2", "business_id": "b2", "caption": " hi ", "label": "odd"},
                  {"photo_id": "p3", "business_id": "zz", "label": "menu"}],
    }
    for name, rows in files.items():
        (folder / f"{name}.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    return tmp_path_factory.mktemp("lake")


@pytest.fixture(scope="module")
def runs(spark, lake):
    base = str(lake / "base")
    first = run_pipeline(spark, write_bronze(lake / "in0", 0), base, LOADS[0], "run-0", 2019)
    kept = {name: df.collect() for name, df in first.tables.items()}
    alerts = {r.source_name for r in first.alerts.collect()}
    failed = first.failed_tests.collect()
    second = run_pipeline(spark, write_bronze(lake / "in1", 1), base, LOADS[1], "run-1", 2019)
    return kept, alerts, failed, second


def test_first_load(runs):
    kept, alerts, failed, _ = runs
    assert len(kept["silver/business"]) == 6 and len(kept["silver/users"]) == 5
    assert {(r.business_id, r.category) for r in kept["silver/business_categories"]} == {
        (f"b{i}", c) for i in range(1, 6) for c in ("Food", "Bars")
    }
    assert {(r.user_id, r.elite_year) for r in kept["silver/user_elite_years"]} == {("u1", 2016), ("u1", 2019)}
    reviews_ = {r.review_id: r for r in kept["gold/fact_reviews"]}
    assert set(reviews_) == {f"r{i}" for i in range(60)}
    assert reviews_["r3"].stars == 5 and str(reviews_["r3"].review_date) == "2019-12-31"
    assert all(r.business_key and r.user_key for r in reviews_.values())
    assert sorted(r.checkin_ordinal for r in kept["gold/fact_checkins"]) == [0, 0, 1, 1]
    assert [r.compliment_count for r in kept["gold/fact_tips"]] == [0]  # the later tip of the day
    assert {(r.photo_id, r.label, r.has_caption) for r in kept["silver/photos"]} == {
        ("p1", "food", False), ("p2", "unknown", True),
    }
    assert len(kept["gold/dim_date"]) == 6940
    assert alerts == {"business", "users", "reviews", "checkins", "tips", "photos"}
    assert failed == []


def test_second_load_versions_and_upserts(spark, runs):
    _, _, failed, second = runs
    business = second.tables["silver/business"].filter("business_id = 'b0'").orderBy("valid_from").collect()
    assert [(r.stars, r.is_current, str(r.valid_to)) for r in business] == [
        (3.5, False, LOADS[1]), (4.0, True, "9999-12-31 00:00:00"),
    ]
    assert second.tables["silver/business"].count() == 7
    assert second.tables["silver/users"].count() == 10
    stored = {r.review_id: str(r.review_date) for r in second.tables["silver/reviews"].collect()}
    assert len(stored) == 61 and stored["new"] == "2020-07-01" and stored["r0"] == "2020-06-01"
    assert second.failed_tests.collect() == []


def test_facts_see_the_version_of_their_time(runs):
    _, _, _, second = runs
    rows = second.tables["gold/fact_reviews"].filter("business_id = 'b0'").collect()
    assert {r.business_stars_at_review_time for r in rows} == {3.5}


def test_log_and_quarantine_per_run(spark, runs, lake):
    base = str(lake / "base")
    log = {(r.pipeline_run_id, r.source_name): r for r in read_log(spark, base).collect()}
    assert len(log) == 12
    first = log["run-0", "reviews"]
    assert (first.bronze_row_count, first.silver_row_count, first.quarantine_count) == (66, 60, 5)
    assert (log["run-0", "checkins"].bronze_row_count, log["run-0", "checkins"].quarantine_count) == (5, 1)
    reasons = read_quarantine(spark, base, "reviews", "run-0").groupBy("reject_reason").count().collect()
    assert {r.reject_reason: r["count"] for r in reasons} == {
        "orphan_business_id": 1, "orphan_user_id": 1, "invalid_stars": 1, "empty_text": 1, "null_review_id": 1,
    }
    kept_text = read_quarantine(spark, base, "reviews", "run-0").filter("reject_reason = 'invalid_stars'").first()
    assert kept_text.text.startswith("word ")


def test_broken_lines_are_quarantined(spark, lake, runs, tmp_path):
    """One line of each file is no JSON: it is rejected with its text, and counted."""
    source = tmp_path / "in"
    shutil.copytree(lake / "in0", source)
    for file in source.iterdir():
        file.write_text(file.read_text() + "\n{broken " + file.stem)
    base = str(tmp_path / "base")
    result = run_pipeline(spark, str(source), base, LOADS[0], "run-0", 2019)
    clean = {r.source_name: r for r in read_log(spark, str(lake / "base")).filter("pipeline_run_id = 'run-0'").collect()}
    for r in result.metrics.collect():
        assert r.bronze_row_count == clean[r.source_name].bronze_row_count + 1
        assert r.silver_row_count == clean[r.source_name].silver_row_count
        assert r.quarantine_count == clean[r.source_name].quarantine_count + 1
        kept = read_quarantine(spark, base, r.source_name).filter("_corrupt_record is not null").collect()
        assert len(kept) == 1 and kept[0]._corrupt_record.startswith("{broken")
    assert result.failed_tests.collect() == []


def test_load_without_photos_tips_and_checkins(spark, lake, runs, tmp_path):
    source = tmp_path / "in"
    shutil.copytree(lake / "in0", source)
    for name in ("photo", "tip", "checkin"):
        (source / f"{name}.json").write_text("")
    for load in LOADS:
        result = run_pipeline(spark, str(source), str(tmp_path / "base"), load, load[:4], 2019)
        assert all(result.tables[f"silver/{name}"].isEmpty() for name in ("photos", "tips", "checkins"))
        assert result.tables["gold/agg_business_monthly"].count() > 0


def test_late_load_is_refused(spark, lake, runs):
    with pytest.raises(ValueError, match="older"):
        run_pipeline(spark, str(lake / "in0"), str(lake / "base"), "2020-06-01 00:00:00", "late", 2019)


def test_text_is_neither_staged_nor_shuffled(spark, runs, lake):
    catalog = Catalog(spark, str(lake / "base"))
    for name in ("reviews", "tips"):
        assert "text" not in catalog.table(f"staging/{name}").columns


def test_full_mode_drops_history(spark, lake, runs, tmp_path):
    result = run_pipeline(
        spark, str(lake / "in0"), str(tmp_path / "full"), LOADS[0], "run-0", 2019, load_mode="full"
    )
    again = run_pipeline(
        spark, str(lake / "in1"), str(tmp_path / "full"), LOADS[1], "run-1", 2019, load_mode="full"
    )
    assert result.tables["silver/business"].count() == 6
    assert again.tables["silver/business"].filter("not is_current").isEmpty()
    with pytest.raises(ValueError):
        run_pipeline(spark, str(lake / "in0"), str(tmp_path / "x"), LOADS[0], "r", 2019, load_mode="other")


def test_models_resolve_by_name(spark, runs, lake, tmp_path):
    source, catalog = Catalog(spark, str(lake / "base")), Catalog(spark, str(tmp_path / "other"))
    for name in ("silver/business", "silver/users", "silver/reviews", "silver/tips"):
        write_table(source.table(name), catalog.base, name)
    define_gold(catalog)
    monthly = catalog.table("gold/agg_business_monthly")  # nothing below it is written yet
    stored = source.table("gold/agg_business_monthly")
    columns = [c for c in stored.columns if c != "aggregated_at"]
    assert monthly.count() == stored.count()
    assert monthly.select(*columns).exceptAll(stored.select(*columns)).isEmpty()


def test_stream_equals_batch(spark, runs, lake, tmp_path):
    source, base = Catalog(spark, str(lake / "base")), str(tmp_path / "stream")
    for name in ("silver/business", "silver/users"):
        write_table(source.table(name), base, name)
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    for load in (0, 1):
        shutil.copy(lake / f"in{load}" / "review.json", incoming / f"{load}.json")
        query = stream_reviews(spark, str(incoming), base, LOADS[load], str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
    columns = [c for c in source.table("silver/reviews").columns if c != "loaded_at"]
    got = Catalog(spark, base).table("silver/reviews").select(*columns)
    want = source.table("silver/reviews").select(*columns)
    assert got.count() == 61 and got.exceptAll(want).isEmpty()
    assert read_quarantine(spark, base, "reviews").agg(F.count(F.lit(1))).first()[0] == 5


def test_a_late_load_is_spliced_in(spark, tmp_path):
    """Three loads, the middle one last: the versions are those of the sorted loads."""

    def state(load):
        return [{**b, "stars": (3.0, 4.0, 3.0)[load]} if b["business_id"] in ("b0", "b1") else b for b in businesses(0)]

    loads = ("2020-01-01 00:00:00", "2020-06-01 00:00:00", "2021-01-01 00:00:00")
    got = {}
    for name, order in (("sorted", (0, 1, 2)), ("late", (2, 0, 1))):
        base = str(tmp_path / name / "base")
        catalog = None
        for load in order:
            folder = tmp_path / name / f"in{load}"
            folder.mkdir(parents=True)
            for entity, rows in {"business": state(load), "user": users(load == 1), "review": reviews(0)[:5], "checkin": [], "tip": [], "photo": []}.items():
                (folder / f"{entity}.json").write_text("\n".join(json.dumps(r) for r in rows))
            catalog = run_silver(spark, str(folder), base, loads[load], f"run-{load}", 2019, late="splice")
        columns = {"silver/business": ("business_id", "stars"), "silver/users": ("user_id", "review_count")}
        got[name] = {t: sorted(map(str, catalog.table(t).select(*c, "valid_from", "valid_to", "is_current").collect())) for t, c in columns.items()}
    assert got["late"] == got["sorted"]
    assert len(got["sorted"]["silver/business"]) == 6 + 2 * 2
    with pytest.raises(ValueError):
        run_silver(spark, str(tmp_path / "late" / "in0"), str(tmp_path / "late" / "base"), loads[0], "run", 2019, late="never")
