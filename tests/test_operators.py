"""Ordered neighbours, de-duplication, lookups and merges, including skewed keys."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wakeline.operators.dedup import dedup_latest
from wakeline.operators.incremental import EPOCH, incremental_cutoff
from wakeline.operators.joins import left_lookup
from wakeline.operators.merge import merge_into, merge_upsert
from wakeline.operators.sequence import EDGE, PART, WHOLE_KEYS, in_ranges, track_layout, with_latest, with_previous
from wakeline.plans import dark, speed
from wakeline.plans.staging import stg_vessel_positions
from wakeline.sources import snapshots
from wakeline.sources.storage import Storage

START = datetime(2024, 1, 1)


def skewed(spark, rows=3000, seed=7):
    """One vessel holds a third of the rows, all of its second day in one hour."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        if i % 3 == 0:
            ts = START + timedelta(days=1, microseconds=rng.randrange(3_600_000_000))
            data.append(("hot", ts, float(i)))
        else:
            ts = START + timedelta(microseconds=rng.randrange(6 * 86_400_000_000))
            data.append((f"v{rng.randrange(40)}", ts, float(i)))
    return spark.createDataFrame(data, "mmsi string, event_timestamp timestamp, x double").dropDuplicates(
        ["mmsi", "event_timestamp"]
    )


def rows(df):
    return sorted((tuple(r) for r in df.select("mmsi", "event_timestamp", "x", "before").collect()), key=repr)


@pytest.mark.parametrize("per_day", [None, "day"])
@pytest.mark.parametrize("limit", [10, 100, 10_000])
def test_previous_equals_plain_lag(spark, per_day, limit):
    df = skewed(spark).withColumn("day", F.to_date("event_timestamp"))
    keys = ["mmsi", "day"] if per_day else ["mmsi"]
    plain = df.withColumn("before", F.lag("x").over(Window.partitionBy(*keys).orderBy("event_timestamp")))
    layout = track_layout(df, "mmsi", "event_timestamp", rows_per_window=limit, ranges=60 if limit == 10 else None)
    assert layout.whole_keys == (limit == 10_000)
    got = with_previous(df, {"before": "x"}, per_day=per_day, layout=layout)
    assert rows(got) == rows(plain)


def one_second(spark, rows=3000):
    """A third of the rows is one vessel's in one second, half of these copies of one position; one vessel has no name."""
    data = [("hot", START + timedelta(microseconds=0 if i % 2 else i), float(i % 7)) for i in range(rows // 3)]
    data += [(None if i % 50 == 0 else f"v{i % 40}", START + timedelta(seconds=i), float(i)) for i in range(rows - len(data))]
    return spark.createDataFrame(data, "mmsi string, event_timestamp timestamp, x double").repartition(5)


@pytest.mark.parametrize("make, limit", [(skewed, 100), (one_second, 100), (one_second, 600)])
def test_ranges_stay_within_the_limit(spark, make, limit):
    df = make(spark)
    layout = track_layout(df, "mmsi", "event_timestamp", rows_per_window=limit)
    hot = df.join(layout.hot, F.col("mmsi").eqNullSafe(F.col("_hot_key")), "left_semi")
    ranged = in_ranges(hot, ["mmsi"], ["event_timestamp"], layout.ranges, before={"before": "x"})
    sizes = [r["count"] for r in ranged.groupBy(PART).count().collect()]
    assert sum(sizes) == hot.count() and max(sizes) <= limit and len(sizes) > 1
    assert ranged.filter(F.col(EDGE) > 0).count() <= 2 * len(sizes)


@pytest.mark.parametrize("per_day", [None, "day"])
@pytest.mark.parametrize("limit", [30, 200])
def test_previous_with_copies_in_one_second(spark, per_day, limit):
    """Copies tie, so which of them comes first is open; how often every pair of neighbours occurs is not."""
    df = one_second(spark).withColumn("day", F.to_date("event_timestamp")).withColumn("at", F.col("event_timestamp"))
    window = Window.partitionBy("mmsi", *([per_day] if per_day else [])).orderBy("event_timestamp", "x")
    plain = df.withColumns({"before": F.lag("x").over(window), "earlier": F.lag("at").over(window)})
    layout = track_layout(df, "mmsi", "event_timestamp", rows_per_window=limit)
    got = with_previous(df, {"before": "x", "earlier": "at"}, ties=("x",), per_day=per_day, layout=layout)
    columns = ["mmsi", "event_timestamp", "x", "before", "earlier"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


@pytest.mark.parametrize("limit", [30, 200, 10_000])
def test_latest_value_along_the_track(spark, limit):
    """Values are rare, so that many ranges have none and look several ranges back."""
    df = one_second(spark).withColumns({"at": F.col("event_timestamp"), "rare": F.when(F.col("x") % 97 == 3, F.col("x"))})
    df = df.withColumn("rare", F.when((F.col("mmsi") == "hot") & (F.unix_micros("at") % 1000 == 7), 1.0).otherwise(F.col("rare")))
    window = Window.partitionBy("mmsi").orderBy("event_timestamp", "x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = df.withColumn("before", F.last("rare", ignorenulls=True).over(window))
    layout = track_layout(df, "mmsi", "event_timestamp", rows_per_window=limit)
    got = with_latest(df, {"before": "rare"}, ties=("x",), layout=layout)
    assert rows(got) == rows(plain)


def test_tracks_that_fit_keep_the_plain_window(spark):
    df = one_second(spark)
    out = with_previous(df, {"before": "x"}, layout=track_layout(df, "mmsi", "event_timestamp", rows_per_window=500))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Window [lag(" in plan and "tracks-" not in plan.split("Union")[0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3 * 86_400)), min_size=1, max_size=40, unique=True))
def test_previous_on_any_track(spark, points):
    df = spark.createDataFrame(
        [(k, START + timedelta(seconds=s), float(s)) for k, s in points], "mmsi string, event_timestamp timestamp, x double"
    )
    plain = df.withColumn("before", F.lag("x").over(Window.partitionBy("mmsi").orderBy("event_timestamp")))
    layout = track_layout(df, "mmsi", "event_timestamp", rows_per_window=2)
    assert rows(with_previous(df, {"before": "x"}, layout=layout)) == rows(plain)


def test_dedup_keeps_the_latest_and_shrinks_before_the_shuffle(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "old"), ("a", 1, 2, "new"), ("a", 2, 1, "only"), ("b", 1, 1, "other")],
        "mmsi string, event_timestamp int, ingestion_timestamp int, tag string",
    )
    out = dedup_latest(df)
    assert sorted(r["tag"] for r in out.collect()) == ["new", "only", "other"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


@pytest.mark.parametrize("limit", [1, 1000])
def test_lookup_beyond_the_broadcast_limit(spark, limit):
    left = skewed(spark)
    right = left.select("mmsi").distinct().filter("mmsi <> 'v3'").withColumn("name", F.upper("mmsi"))
    out = left_lookup(left, right, "mmsi", F.col("event_timestamp"), max_rows=limit, salts=8)
    expected = left.join(right, "mmsi", "left")
    assert out.columns == expected.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, expected.collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (limit == 1)


def test_merge_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    assert sorted(map(tuple, merge_upsert(target, updates, "id").collect())) == [(1, "a"), (2, "B"), (3, "C")]
    wider = updates.withColumn("w", F.lit(1)).drop("v")
    out = merge_upsert(target, wider, "id", sync_schema=True)
    assert out.columns == ["id", "w"]
    assert sorted(map(tuple, out.collect())) == [(1, None), (2, 1), (3, 1)]


def test_merge_into_rewrites_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "id int, v string, day date"
    d1, d2, d3 = (datetime(2024, 1, d).date() for d in (1, 2, 3))
    merge_into(spark, path, spark.createDataFrame([(1, "a", d1), (2, "b", d2)], schema), "id", "day")
    first = snapshots.newest(Storage(spark, path)).days
    updates = spark.createDataFrame([(2, "B", d2), (3, "C", d3), (4, "D", d2)], schema)
    for _ in range(2):  # a second run changes nothing
        merge_into(spark, path, updates, "id", "day")
    got = sorted((r["id"], r["v"]) for r in snapshots.read(spark, path).collect())
    assert got == [(1, "a"), (2, "B"), (3, "C"), (4, "D")]
    now = snapshots.newest(Storage(spark, path)).days
    assert now["day=2024-01-01"] == first["day=2024-01-01"] and now["day=2024-01-02"] != first["day=2024-01-02"]


def test_cutoff_of_missing_and_empty_targets(spark):
    empty = spark.createDataFrame([], "t timestamp")
    assert incremental_cutoff(None, "t", 6) == EPOCH == incremental_cutoff(empty, "t", 6)
    one = spark.sql("select timestamp'2024-01-01 06:30:00.000001' t")
    assert incremental_cutoff(one, "t", 6) == datetime(2024, 1, 1, 0, 30, 0, 1)


@pytest.mark.parametrize("model, moment, key", [
    (dark.vessel_dark_events, "signal_recovered_at", "dark_event_id"),
    (speed.vessel_speed_anomalies, "event_timestamp", "anomaly_id"),
])
def test_full_refresh_equals_incremental_runs(frames, model, moment, key):
    full = model(frames.stg, layout=frames.layout)
    early = F.lit("2024-01-02 00:00:00").cast("timestamp")
    seen = frames.stg.filter(F.col("event_timestamp") < early)
    stored = model(seen, layout=frames.layout)
    later = merge_upsert(stored, model(frames.stg, target=stored, layout=frames.layout), key)
    assert sorted(r[0] for r in later.select(key).collect()) == sorted(r[0] for r in full.select(key).collect())
    compat = model(frames.stg, target=stored, compat=True, layout=frames.layout)
    assert compat.count() <= later.count()


def test_critical_gap_and_compat(spark):
    schema = (
        "mmsi string, vessel_name string, flag_country string, vessel_type_normalized string, latitude double, "
        "longitude double, ocean_region string, port_name string, port_country string, event_timestamp timestamp"
    )
    stg = spark.createDataFrame([
        ("1", "A", "NL", "cargo", 51.9, 4.1, "o", "Rotterdam", "NL", START),
        ("1", "A", "NL", "cargo", 53.5, 9.9, "o", "Hamburg", "DE", START + timedelta(hours=13)),
    ], schema)
    event = dark.vessel_dark_events(stg, layout=WHOLE_KEYS).collect()[0]
    assert (event["severity"], event["gap_minutes"], event["reappeared_in_other_port"]) == ("CRITICAL", 780, True)
    assert len(event["dark_event_id"]) == 32
    target = spark.createDataFrame([(START + timedelta(hours=12),)], "signal_recovered_at timestamp")
    assert dark.vessel_dark_events(stg, target=target, layout=WHOLE_KEYS).count() == 1
    assert dark.vessel_dark_events(stg, target=target, compat=True, layout=WHOLE_KEYS).count() == 0


def test_staging_same_with_and_without_broadcast(frames):
    narrow = ["mmsi", "event_timestamp", "vessel_type_normalized", "destination_clean"]
    one = stg_vessel_positions(frames.silver, frames.metadata, meta_tie_break=("_row_id",)).select(*narrow)
    two = stg_vessel_positions(
        frames.silver, frames.metadata, meta_tie_break=("_row_id",), broadcast_rows=1
    ).select(*narrow)
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_models_do_not_depend_on_the_layout(frames):
    from wakeline.plans.alerts import vessel_alerts_batch

    sliced = track_layout(frames.bronze, "MMSI", "time_utc", rows_per_window=5, ranges=40)
    assert not sliced.whole_keys
    for build in (
        lambda layout: vessel_alerts_batch(frames.bronze, layout=layout),
        lambda layout: speed.vessel_speed_anomalies(frames.stg, layout=layout).drop("processing_timestamp"),
    ):
        assert sorted(map(str, build(sliced).collect())) == sorted(map(str, build(WHOLE_KEYS).collect()))


def test_cutoff_prunes_day_folders(spark, tmp_path):
    from wakeline.operators.incremental import since

    path = str(tmp_path / "t")
    skewed(spark, 300).withColumn("partition_date", F.to_date("event_timestamp")).write.partitionBy("partition_date").parquet(path)
    recent = since(spark.read.parquet(path), START + timedelta(days=4))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and "PushedFilters: [IsNotNull(event_timestamp)" in plan
    assert recent.count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_by_vessel_up_to_staging(spark, frames):
    """De-duplication, deltas and a lookup past the broadcast limit take one shuffle of the positions together."""
    silver = plan_of(frames.silver)
    assert silver.count("Exchange hashpartitioning(") == 1
    stg = stg_vessel_positions(frames.silver, frames.metadata, meta_tie_break=("_row_id",), broadcast_rows=1, layout=frames.layout)
    assert plan_of(stg).count("Exchange hashpartitioning(") == 2  # positions, static data
    two = plan_of(dark.vessel_dark_events(stg, layout=frames.layout))
    assert two.count("Exchange hashpartitioning(") == 2 and "Generate" not in two


def test_hot_vessels_write_only_what_activity_reads(spark, frames):
    from wakeline.plans import activity
    from wakeline.registry import sliced

    days = activity.vessel_activity_summary(frames.stg, layout=sliced(frames))
    ranged = [line for line in days._jdf.queryExecution().analyzed().toString().splitlines() if "Relation" in line and PART in line]
    assert ranged and not any(c in line for line in ranged for c in ("callsign", "imo_number", "course_over_ground"))


def test_queries_that_read_staging_often_write_it_once(frames):
    from wakeline.registry import QUERIES, Frames

    for name in ("report_table_counts", "dark_events_seeded"):
        df = QUERIES[name](Frames(frames.spark, frames.sf_dir))
        assert not any(f.endswith("/events.parquet") for f in df.inputFiles())
