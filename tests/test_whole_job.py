"""Rows, numbers and steps that used to be left out of domain operators and queries."""

from datetime import datetime

from riffle.operators import fish
from riffle.plans import QUERIES

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"


def events_folder(spark, folder, rows):
    spark.createDataFrame(rows, EVENTS).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_density_has_a_row_per_site_and_length(spark):
    catch = spark.createDataFrame([("ef1", "RB", "fry", 1, 6)],
                                  "local_name string, species_code string, life_stage string, "
                                  "haul_number_pass_number int, catch long")
    events = spark.createDataFrame(
        [("ef1", 10.0, 2.0, 300, "open"), ("ef1", 10.0, 2.0, 200, "shut"), ("ef1", 20.0, 3.0, 400, "open"),
         ("ef1", 10.0, 2.5, 100, "open")],
        "local_name string, ef_length_m double, ef_width_m double, ef_seconds int, enclosure string")
    got = sorted((r.ef_length_m, r.ef_width_m, r.ef_seconds, r.enclosure, r.area_m2, r.density_100m2)
                 for r in fish.density(catch, events).collect())
    assert got == [(10.0, 2.0, 200, "shut", 20.0, 30.0), (20.0, 3.0, 400, "open", 60.0, 10.0)]


def test_slice_order_numbers_rows_over_the_whole_frame(spark, tmp_path):
    rows = [(i, datetime(2024, 1, 1 + i % 3), 100 - i % 11, "view", 1.0) for i in range(250)]
    got = QUERIES["slice_order"](spark, events_folder(spark, tmp_path, rows))
    assert got.columns == ["event_id", "user_text", "ts", "row_id"]
    ordered = sorted(rows, key=lambda r: (r[2], r[1], r[0]))
    assert sorted((r.row_id, r.event_id, r.user_text) for r in got.collect()) == [
        (k, r[0], str(r[2])) for k, r in enumerate(ordered, 1) if k > 100]


def test_waypoint_merge_has_all_points_and_the_newest_of_a_key(spark, tmp_path):
    day = lambda y, d=1: datetime(y, 1, d)
    rows = [(1230, day(2023), 2, "view", 1.0), (1229, day(2024, 5), 2, "signup", 2.0), (123, day(2024, 3), 2, "view", 3.0),
            (1228, day(2024, 5), 2, "click", 4.0),
            (1234, day(2024), 4, "purchase", 0.0), (1235, day(2022), 4, "error", 0.0), (1236, day(2024), 5, "error", 0.0)]
    got = {}
    for r in QUERIES["waypoint_merge"](spark, events_folder(spark, tmp_path, rows)).collect():
        got.setdefault(r.event_id, set()).add((r.wp_key, r.wp_event_id, r.name, r.newest_event_id, r.newest_easting))
    at = lambda key, newest, *points: {(key, p, n, *newest) for p, n in points}
    all_points = [(1230, "123_R1_2023"), (1229, "123_R1_2024"), (123, "123_R1_2024")]
    assert got == {1234: at("123_R1_2024", (1229, 2000.0), *all_points),
                   1235: at("123_R1_2022", (None, None), *all_points),
                   1236: at("123_R2_2024", (1228, 4000.0), (1228, "123_R2_2024"))}
