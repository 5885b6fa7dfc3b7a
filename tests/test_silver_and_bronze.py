"""Literal rows through bronze, routing and silver."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.plans import bronze, loiter, ports, silver
from wakeline.quality.expectations import expect, failed
from wakeline.quality.suites import SUITES
from wakeline.sources.layers import check_schema, null_profile
from wakeline.sources.routing import route_messages
from wakeline.sources.streams import parse_json, to_keyed_json

T0 = datetime(2025, 3, 4, 23, 40)
# (MMSI, latitude, longitude, Sog, Cog, TrueHeading, NavigationalStatus, minutes after T0)
SHIPS = [
    ("246000101", 53.9, 9.5, 0.4, 359.9, 510, 5, 0),  # inside a corner of the Hamburg box
    ("246000101", 54.1, 9.5, 9.1, 12.0, 7, 0, 25),  # out of it, and into the next day
    ("701555000", -23.4, -46.8, 102.3, 360.0, 511, 15, 3),  # on the edge of the Santos box, everything unknown
    ("000000001", 29.9, 20.0, 33.0, 181.5, 181, 8, 1),  # no flag; where two regions meet
    ("667222333", 8.0, -70.0, 1.0, 0.0, 0, 1, 2),
]


def bronze_rows(spark, ships, **extra):
    def row(ship):
        mmsi, lat, lon, sog, cog, heading, nav, minute = ship
        known = {
            "MMSI": mmsi, "Latitude": lat, "Longitude": lon, "Sog": sog, "Cog": cog, "TrueHeading": heading,
            "NavigationalStatus": nav, "ShipName": f" SHIP {mmsi} ", "time_utc": T0 + timedelta(minutes=minute),
            "ingestion_timestamp": T0, "_batch_id": "b1", **extra,
        }
        return tuple(known.get(name) for name in schemas.names(schemas.BRONZE_POSITIONS))

    return spark.createDataFrame([row(s) for s in ships], schemas.ddl(schemas.BRONZE_POSITIONS))


def test_silver_literal_rows(spark):
    for scope in ("batch", "table"):
        out = silver.silver_positions(bronze_rows(spark, SHIPS), scope=scope)
        assert check_schema(out, schemas.SILVER_POSITIONS) == []
        got = {(r["mmsi"], int((r["event_timestamp"] - T0).total_seconds()) // 60): r for r in out.collect()}
        assert len(got) == len(SHIPS)
        inside, left = got["246000101", 0], got["246000101", 25]
        assert (inside["port_name"], inside["port_country"], inside["is_in_port_zone"]) == ("Hamburg", "DE", True)
        assert inside["distance_to_port_km"] > 0 and inside["navigational_status"] == "moored"
        assert (left["port_name"], left["is_in_port_zone"], left["distance_to_port_km"]) == (None, False, None)
        assert (inside["speed_change_rate"], inside["heading_change_degrees"]) == (None, None)
        assert (round(left["speed_change_rate"], 6), left["heading_change_degrees"]) == (8.7, 503.0)
        unknown = got["701555000", 3]
        assert (unknown["speed_over_ground"], unknown["course_over_ground"], unknown["heading"]) == (None, None, None)
        assert (unknown["port_name"], unknown["flag_country"], unknown["navigational_status"]) == ("Santos", "AR", "undefined")
        meeting, river = got["000000001", 1], got["667222333", 2]
        assert (meeting["flag_country"], meeting["ocean_region"]) == (None, "indian_ocean")
        assert (river["flag_country"], river["ocean_region"], river["navigational_status"]) == ("SL", "atlantic_ocean", "at_anchor")
        assert inside["vessel_name"] == "SHIP 246000101"


def test_silver_keeps_the_latest_copy(spark):
    old = bronze_rows(spark, SHIPS[:1])
    new = bronze_rows(spark, SHIPS[:1], ingestion_timestamp=T0 + timedelta(minutes=5), _batch_id="b2")
    out = silver.silver_positions(old.unionByName(new)).collect()
    assert [r["_bronze_batch_id"] for r in out] == ["b2"]


def test_metadata_name_fallback_and_type(spark):
    rows = [
        ("1", "", 7, None, None, "Name", "tbd", 1.5, None), ("2", None, None, 12, " C ", " Name ", " oslo", None, None),
        (None, "x", 1, 1, "c", "n", "d", 1.0, None),
    ]
    out = {r["mmsi"]: r for r in silver.silver_metadata(
        spark.createDataFrame(rows, schemas.ddl(schemas.BRONZE_METADATA_INPUT))).collect()}
    assert set(out) == {"1", "2"}
    assert (out["1"]["vessel_name"], out["1"]["vessel_type_normalized"], out["1"]["destination_clean"]) == ("", "other", None)
    assert (out["2"]["vessel_name"], out["2"]["vessel_type_normalized"], out["2"]["destination_clean"]) == ("Name", None, "OSLO")
    assert (out["2"]["imo_number"], out["2"]["callsign"]) == ("12", "C")


def message(kind="PositionReport", mmsi=224123456, lat=41.3, lon=2.1, time="2026-03-12 13:09:41.810776108 +0000 UTC", user=1, **meta):
    report = {"Latitude": lat, "Longitude": lon, "Sog": 5.0, "UserID": user, "Extra": 1}
    body = {"Message": {kind: report}, "MessageType": kind, "MetaData": {"MMSI": mmsi, "time_utc": time, **meta}}
    return json.dumps(body)


def test_routing(spark):
    texts = {
        "good": message(), "static": message("ShipStaticData", lat=None, lon=None), "base": message("BaseStationReport"),
        "broken": "{nope", "no_mmsi": message(mmsi=None, user=None), "user_id": message(mmsi=0, user=77),
        "north": message(lat=91.0), "zero": message(lat=0.0), "zero_meta": message(lat=0.0, latitude=12.0),
        "no_time": message(time=None), "bad_time": message(time="soon"),
    }
    raw = spark.createDataFrame([(k, v) for k, v in texts.items()], "name string, value string")
    fallback = F.lit("2000-01-01 00:00:00").cast("timestamp")
    positions, metadata, rejected = route_messages(raw, fallback_time=fallback)
    assert positions.count() == 5 and metadata.count() == 1
    reasons = {r["original_data"]: (r["error"], r["source"]) for r in rejected.collect()}
    assert {k: reasons[v][0] for k, v in texts.items() if v in reasons} == {
        "base": "unhandled_type", "broken": "invalid_json", "no_mmsi": "missing_mmsi", "north": "invalid_position",
        "zero": "invalid_position",
    }
    times = {r["t"] for r in positions.select(F.col("MetaData.time_utc").alias("t")).collect()}
    assert times == {"2026-03-12T13:09:41.810776+00:00", None, "2000-01-01T00:00:00.000000+00:00"}


def test_bronze_validation_and_lineage(spark):
    texts = [
        message(time="2026-03-12T23:30:00+00:00"), message(lat=None), message(lon=181.0), message(time="junk"),
        message("ShipStaticData"), "{broken",
    ]
    raw = parse_json(spark.createDataFrame([(t,) for t in texts], "value string"), schemas.RAW_POSITION)
    out = bronze.bronze_positions(raw, "b7", version="1", source_file="/archive")
    assert check_schema(out, schemas.BRONZE_POSITIONS + schemas.BRONZE_POSITION_PARTITIONS) == []
    (row,) = out.collect()
    assert (str(row["partition_date"]), row["partition_hour"], row["_batch_id"]) == ("2026-03-12", 23, "b7")
    assert bronze.rejected_positions(bronze.flatten_positions(raw)).count() == 2
    keyed = to_keyed_json(out).first()
    assert keyed["key"] == "224123456" and json.loads(keyed["value"])["_batch_id"] == "b7"


def test_null_profile_and_check_schema(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert [tuple(r) for r in null_profile(df, ["a", "b"]).collect()] == [("a", 3, 1, 33.3), ("b", 3, 2, 66.7)]
    assert check_schema(df, [("a", "bigint"), ("c", "int")]) == [
        "missing column c", "undeclared column b", "a is int, declared bigint",
    ]


def test_loiter_keeps_unknown_status(spark):
    schema = (
        "mmsi string, vessel_name string, vessel_type_normalized string, flag_country string, ocean_region string, "
        "latitude double, longitude double, event_timestamp timestamp, date_day date, speed_over_ground double, "
        "heading_change_degrees double, navigational_status string, is_in_port_zone boolean"
    )
    rows = [
        ("1", "a", "tug", "NL", "o", 10.02, 20.01, T0 + timedelta(minutes=m), T0.date(), 1.0, -30.0, nav, zone)
        for m, nav, zone in [(0, None, None), (200, "undefined", False), (800, None, False), (900, "moored", False), (901, None, True)]
    ]
    (stay,) = loiter.vessel_loitering(spark.createDataFrame(rows, schema)).collect()
    assert (stay["position_count"], stay["duration_minutes"], stay["risk_level"], stay["loiter_zone"]) == (3, 800, "HIGH", "10.0_20.0")


def test_port_types_sum_to_vessels_and_modes_differ(frames):
    first, transition = ports.port_traffic(frames.stg), ports.port_traffic(frames.stg, entry_mode="transition")
    total = " + ".join(f"{c}_vessels" for c in ("cargo", "tanker", "passenger", "fishing", "tug", "special_craft", "sailing_or_pleasure", "high_speed_craft", "other"))
    assert first.filter(f"{total} <> unique_vessels").count() == 0
    entries = [df.agg(F.sum("vessel_entries")).first()[0] for df in (first, transition)]
    assert entries[0] < entries[1]
    assert first.join(ports.port_entries(frames.stg), ["port_name", "date_day"], "left_anti").filter("vessel_entries > 0").count() == 0


def test_expectations_report_failures(spark):
    from wakeline.quality.expectations import accepted_values, is_true, not_constant, not_null, unique, unique_combination

    df = spark.createDataFrame([(1, "a", None), (1, "b", 5), (2, "z", -1), (None, "a", 1)], "k int, s string, n int")
    rules = [
        *not_null("k"), accepted_values("s", "a", "b"), is_true("n_positive", "n > 0", "warn"), unique("k"),
        unique_combination("k", "s"), not_constant("s"), not_constant("k"),
    ]
    got = {r["name"]: (r["failures"], r["passed"]) for r in expect(df, rules).collect()}
    assert got == {
        "not_null_k": (1, False), "accepted_values_s": (1, False), "n_positive": (1, False), "unique_k": (1, False),
        "unique_k_s": (0, True), "not_constant_s": (0, True), "not_constant_k": (0, True),
    }
    assert failed(expect(df, rules)).count() == 3
    assert expect(df.filter("k = 1"), [not_constant("k")]).first()["passed"] is False


def test_suites_hold_104_rules():
    assert sum(map(len, SUITES.values())) == 104


def test_expectations_read_the_model_once(frames):
    plan = expect(frames.activity, SUITES["vessel_activity_summary"])._jdf.queryExecution().executedPlan().toString()
    once = frames.activity._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("FileScan") == once.count("FileScan")


def test_expectations_on_an_empty_table(spark):
    from wakeline.quality.expectations import not_constant, not_null, unique

    df = spark.createDataFrame([], "k int, s string")
    got = {r["name"]: r["failures"] for r in expect(df, [*not_null("k"), unique("k"), not_constant("s")]).collect()}
    assert got == {"not_null_k": 0, "unique_k": 0, "not_constant_s": 1}
    assert [r["failures"] for r in expect(df, not_null("k")).collect()] == [0]


def test_visits_to_a_cell_are_stays_of_their_own(spark):
    """Two visits of four hours to one cell with a trip to another in between, and a silence that ends a third."""
    base = datetime(2024, 5, 1)
    hours = [(h, 10.0) for h in range(0, 5)] + [(5, 11.0)] + [(h, 10.0) for h in range(6, 11)] + [(h, 10.0) for h in range(40, 45)]
    rows = [("1", "N", "cargo", "DE", "r", base + timedelta(hours=h), base.date(), 2.0, 30.0, lat, 20.0, None, False) for h, lat in hours]
    schema = ("mmsi string, vessel_name string, vessel_type_normalized string, flag_country string, ocean_region string, "
              "event_timestamp timestamp, date_day date, speed_over_ground double, heading_change_degrees double, "
              "latitude double, longitude double, navigational_status string, is_in_port_zone boolean")
    df = spark.createDataFrame(rows, schema)
    got = sorted((r["window_start"].hour, r["position_count"], r["duration_minutes"]) for r in loiter.vessel_loitering(df, sessionize=600).collect())
    assert got == [(0, 5, 240), (6, 5, 240), (16, 5, 240)]
    (one,) = loiter.vessel_loitering(df).collect()
    assert one["position_count"] == 15
