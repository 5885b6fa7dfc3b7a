"""Compaction with crashes, freshness, layer views and the gold refresh."""

import os
import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wakeline import schemas
from wakeline.operators.merge import merge_into
from wakeline.plans.day_ends import roster
from wakeline.plans.refresh import TIES, refresh_day_ends, refresh_gold, stored
from wakeline.sources import snapshots
from wakeline.sources.compaction import compact
from wakeline.sources.layers import is_fresh, register_layers
from wakeline.sources.sinks import materialize, write_idempotent
from wakeline.sources.storage import Storage

DATASET, DAY = "vessel_positions", "2020-01-01"


class Crash(RuntimeError):
    pass


class Crashing(Storage):
    """Stops the writer before its n-th file operation, whatever it is; half a commit file may be left."""

    def __init__(self, spark, root, nth, torn=False):
        super().__init__(spark, root)
        self.left, self.torn, self.done = nth, torn, 0

    def _step(self):
        self.left -= 1
        self.done += 1
        if self.left == 0:
            raise Crash

    def create(self, name, text):
        try:
            self._step()
        except Crash:
            if self.torn:
                super().create(name, text[: len(text) // 2])
            raise
        super().create(name, text)

    def delete(self, name):
        self._step()
        super().delete(name)


@pytest.fixture
def path(spark, tmp_path):
    """Two days in plain folders of six and three files, as streams leave them."""
    root = f"{tmp_path}/silver/{DATASET}"
    for first in range(0, 900, 100):
        append(spark, root, first, 100, DAY if first < 600 else "2020-01-02")
    return root


def append(spark, root, first, rows, day=DAY):
    frame = spark.range(first, first + rows).selectExpr("id", "id * 1.5 as speed", f"date'{day}' as partition_date")
    frame.coalesce(1).write.mode("append").partitionBy("partition_date").parquet(root)


def ids(spark, root):
    return sorted(r["id"] for r in snapshots.read(spark, root).collect())


def run_compaction(spark, root, storage=None, **options):
    base, dataset = root.rsplit("/", 1)
    return compact(spark, base, dataset, DAY, storage=storage, **options)


def run_merge(spark, root, storage=None):
    updates = spark.range(550, 620).selectExpr(
        "id", "-1.0D as speed", "if(id < 600, date'2020-01-01', date'2020-01-02') as partition_date")
    merge_into(spark, root, updates, "id", "partition_date", storage=storage)


def run_materialize(spark, root, storage=None):
    materialize(snapshots.read(spark, root).where("id >= 100"), root, "partition_date", ["id"], storage=storage)


def contents(spark, root):
    return sorted((r["id"], float(r["speed"]), str(r["partition_date"])) for r in snapshots.read(spark, root).collect())


@pytest.mark.parametrize("torn", [False, True])
@pytest.mark.parametrize("run", [run_compaction, run_merge, run_materialize])
def test_a_stop_at_any_file_operation_loses_and_doubles_nothing(spark, path, tmp_path, run, torn):
    before = contents(spark, path)
    whole = f"{tmp_path}/whole/{DATASET}"
    shutil.copytree(path, whole)
    run(spark, whole)
    after = contents(spark, whole)
    assert len(after) == len({r[0] for r in after})
    stops = 0
    for nth in range(1, 40):
        copy = f"{tmp_path}/stop{nth}/{DATASET}"
        shutil.copytree(path, copy)
        try:
            run(spark, copy, Crashing(spark, copy, nth, torn))
        except Crash:
            stops += 1
            assert contents(spark, copy) in (before, after)
            run(spark, copy)
        assert contents(spark, copy) == after
        if stops < nth:
            break
    assert 3 <= stops < 39


def test_compaction_and_its_leftovers(spark, path):
    report = run_compaction(spark, path)
    assert (report["status"], report["files_before"], report["files_after"], report["rows"]) == ("compacted", 6, 1, 600)
    assert ids(spark, path) == list(range(900))
    assert not os.path.exists(f"{path}/partition_date={DAY}") and os.path.exists(f"{path}/partition_date=2020-01-02")
    assert run_compaction(spark, path)["status"] == "skipped"
    append(spark, path, 9000, 10)
    assert ids(spark, path) == list(range(900)) + list(range(9000, 9010))
    assert run_compaction(spark, path)["rows"] == 610 and ids(spark, path)[-1] == 9009


def test_rows_that_arrive_during_compaction_stay(spark, path, monkeypatch):
    real = snapshots.change
    monkeypatch.setattr(snapshots, "change", lambda *a, **k: (append(spark, path, 9000, 10), real(*a, **k))[1])
    run_compaction(spark, path)
    assert ids(spark, path) == list(range(900)) + list(range(9000, 9010))


def test_dry_run_target_size_and_temporary_files(spark, path):
    folder = f"{path}/partition_date={DAY}"
    before = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.makedirs(f"{folder}/_temporary/0")
    shutil.copy(f"{folder}/{before[0]}", f"{folder}/_temporary/0/busy.parquet")
    assert run_compaction(spark, path, dry_run=True)["status"] == "dry-run"
    assert sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) == before
    size = sum(os.path.getsize(f"{folder}/{f}") for f in before)
    assert run_compaction(spark, path, target_bytes=size // 2 + 1)["files_after"] == 2
    assert ids(spark, path) == list(range(900))


def test_batch_folders_of_a_stream(spark, tmp_path):
    """Idempotent micro-batches, one of them processed twice, then compacted."""
    root = f"{tmp_path}/silver/{DATASET}"
    for epoch in (0, 1, 1, 2):
        rows = spark.range(epoch * 10, epoch * 10 + 10).withColumn("partition_date", F.lit(DAY).cast("date"))
        write_idempotent(rows, root, epoch, ["partition_date"])
    assert spark.read.parquet(root).count() == 30
    report = run_compaction(spark, root)
    assert (report["files_before"], report["files_after"], report["rows"]) == (3, 1, 30)
    assert ids(spark, root) == list(range(30))
    write_idempotent(spark.range(30, 40).withColumn("partition_date", F.lit(DAY).cast("date")), root, 3, ["partition_date"])
    assert ids(spark, root) == list(range(40))


def test_large_batches_are_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) as s", "date'2020-01-01' as partition_date")
        write_idempotent(rows, str(tmp_path / "t"), 0, ["partition_date"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in os.listdir(tmp_path / "t" / "partition_date=2020-01-01" / "batch=0") if f.endswith(".parquet")]) > 3


def test_guards(spark, path):
    today = datetime.now(timezone.utc).date().isoformat()
    with pytest.raises(ValueError):
        compact(spark, "/nowhere", DATASET, today)
    storage = Storage(spark, path)
    storage.create("_commits/000000000001.json", "{}{")
    with pytest.raises(Exception):
        storage.create("_commits/000000000001.json", "again")
    assert snapshots.newest(storage).number == 0 and ids(spark, path) == list(range(900))


def test_a_table_that_became_empty_keeps_its_columns(spark, path):
    materialize(snapshots.read(spark, path).where("id < 0"), path, "partition_date")
    empty = snapshots.read(spark, path)
    assert empty.count() == 0 and set(empty.columns) == {"id", "speed", "partition_date"}
    assert snapshots.exists(spark, path) and not snapshots.exists(spark, path + "-none")


def test_freshness(spark, path):
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert is_fresh(spark, path, 2)
    assert not is_fresh(spark, path, 2, as_of=now + timedelta(hours=5))


@pytest.fixture(scope="module")
def root(spark, frames, tmp_path_factory):
    """Silver tables on disk; three rows of four in the first load."""
    root = str(tmp_path_factory.mktemp("lake"))
    positions = frames.silver.withColumns({
        "_silver_batch_id": F.lit("s"), "partition_date": F.to_date("event_timestamp"),
    })
    late = F.col("event_timestamp") >= F.lit("2024-01-03 00:00:00").cast("timestamp")
    metadata = frames.metadata.drop("_row_id").withColumns({
        "_silver_batch_id": F.lit("s"), "partition_date": F.to_date("processing_timestamp"),
    })
    positions.filter(~late).write.partitionBy("partition_date").parquet(f"{root}/silver/positions")
    metadata.dropDuplicates(["mmsi", "processing_timestamp"]).coalesce(1).write.parquet(f"{root}/tmp")
    spark.read.parquet(f"{root}/tmp").coalesce(1).write.partitionBy("partition_date").parquet(f"{root}/silver/metadata")
    return root, positions.filter(late)


def test_refresh_full_then_incremental(spark, frames, root):
    path, late = root
    names = ["vessel_dark_events", "vessel_speed_anomalies", "vessel_risk_score"]
    assert refresh_gold(spark, path, as_of="2024-01-04")["status"] == "refreshed"
    before = {n: stored(spark, path, n).count() for n in names}
    late.write.mode("append").partitionBy("partition_date").parquet(f"{path}/silver/positions")
    refresh_gold(spark, path, as_of="2024-01-04")
    after = {n: stored(spark, path, n).count() for n in names}
    assert after["vessel_dark_events"] == frames.dark.count() > before["vessel_dark_events"]
    assert after["vessel_speed_anomalies"] == frames.speed.count() > before["vessel_speed_anomalies"]
    assert after["vessel_risk_score"] == frames.risk.count()
    assert stored(spark, path, "vessel_activity_summary").count() == frames.activity.count()
    refresh_gold(spark, path, as_of="2024-01-04", full_refresh=True)
    assert stored(spark, path, "vessel_loitering").count() == frames.loiter.count()


def test_late_rows_and_static_data_reach_the_ends_of_days(spark, frames, tmp_path):
    """After late rows, late metadata and a future date an incremental run knows what a full one knows."""
    path = str(tmp_path)
    day = F.to_date("event_timestamp")
    positions = frames.silver.withColumns({"_silver_batch_id": F.lit("s"), "partition_date": day})
    metadata = frames.metadata.drop("_row_id").withColumns({
        "_silver_batch_id": F.lit("s"), "partition_date": F.to_date("processing_timestamp"),
    }).dropDuplicates(["mmsi", "processing_timestamp"]).cache()

    def add(rows, table):
        rows.coalesce(1).write.mode("append").partitionBy("partition_date").parquet(f"{path}/silver/{table}")

    def settled():
        ends = refresh_day_ends(spark, path)
        names = ["mmsi", "vessel_name", "vessel_type_normalized", "flag_country", "last_known_port"]
        return (
            sorted(map(repr, roster(ends, TIES).select(names).collect())),
            sorted(map(repr, stored(spark, path, "vessel_erratic_course").drop("gold_processed_at").collect())),
            {r.mmsi: tuple(r) for r in stored(spark, path, "vessel_risk_score").select(names).collect()},
        )

    first = metadata.orderBy("mmsi").first().mmsi
    only_late = positions.where("mmsi is not null and not startswith(mmsi, '0')").agg(F.max("mmsi")).first()[0]
    late = (F.col("mmsi") == only_late) | (F.col("event_timestamp") < "2024-01-02") & (F.hour("event_timestamp") >= 10)
    future = positions.limit(1).withColumns({
        "mmsi": F.lit("999999999"), "event_timestamp": F.lit("2031-05-05 00:00:00").cast("timestamp")})
    add(positions.where(~late), "positions")
    add(future.withColumn("partition_date", day), "positions")
    add(metadata.where(F.col("mmsi") == first), "metadata")
    refresh_gold(spark, path, as_of="2024-01-04", test=False)
    add(positions.where(late), "positions")
    add(metadata.where(F.col("mmsi") != first), "metadata")
    refresh_gold(spark, path, as_of="2024-01-04", test=False)
    known, erratic, risk = settled()
    assert only_late in str(known) and erratic
    refresh_gold(spark, path, as_of="2024-01-04", full_refresh=True, test=False)
    all_known, all_erratic, all_risk = settled()
    assert known == all_known and erratic == all_erratic
    assert risk and all(all_risk[mmsi] == row for mmsi, row in risk.items())
    gone = Storage(spark, f"{path}/silver/positions")
    gone.delete("partition_date=2031-05-05")
    assert refresh_day_ends(spark, path).where("mmsi = '999999999'").count() == 0
    number = snapshots.newest(Storage(spark, f"{path}/gold/vessel_day_ends")).number
    refresh_day_ends(spark, path)
    assert snapshots.newest(Storage(spark, f"{path}/gold/vessel_day_ends")).number == number


EVENTS = ["vessel_dark_events", "vessel_speed_anomalies", "vessel_loitering"]


def test_late_rows_reach_all_events(spark, frames, tmp_path):
    """Rows days late fill gaps, move their ends and make new ones; rows that go take theirs with them."""
    path = str(tmp_path)
    positions = frames.silver.withColumns({"_silver_batch_id": F.lit("s"), "partition_date": F.to_date("event_timestamp")})
    metadata = frames.metadata.drop("_row_id").withColumns({
        "_silver_batch_id": F.lit("s"), "partition_date": F.to_date("processing_timestamp"),
    }).dropDuplicates(["mmsi", "processing_timestamp"])

    def add(rows, table):
        rows.coalesce(1).write.mode("append").partitionBy("partition_date").parquet(f"{path}/silver/{table}")

    def events():
        out = []
        for name in EVENTS:
            rows = stored(spark, path, name)
            kinds = dict(rows.dtypes)
            rows = rows.select(*[F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(c) for c in sorted(rows.columns)])
            out.append(sorted(map(repr, rows.collect())))
        return out

    day = F.col("partition_date").cast("string")
    vessel = F.pmod(F.xxhash64("mmsi"), F.lit(5))
    # The whole first day of some vessels, the second day's afternoon of others; some are seen on the third day only.
    late = (vessel == 0) & (day == "2024-01-01") | (vessel == 1) & (day == "2024-01-02") & (F.hour("event_timestamp") >= 12)
    late = late | (vessel == 2) & (day <= "2024-01-02") | (day == "2024-01-04")
    add(positions.where(~late), "positions")
    add(metadata, "metadata")
    refresh_gold(spark, path, as_of="2024-01-04", test=False)
    first = events()
    add(positions.where(late), "positions")
    Storage(spark, f"{path}/silver/positions").delete("partition_date=2024-01-03")
    before = spark.catalog.listTables()
    refresh_gold(spark, path, as_of="2024-01-04", test=False)
    assert spark.catalog.listTables() == before
    after = events()
    refresh_gold(spark, path, as_of="2024-01-04", full_refresh=True, test=False)
    assert after == events() and all(a != b for a, b in zip(first, after))


def test_models_over_staging_by_vessel_do_not_shuffle_by_vessel(spark, frames):
    from wakeline.plans import activity, dark, loiter, risk, speed

    staged = frames.staged
    assert staged.hot is None
    for model in (dark.vessel_dark_events, speed.vessel_speed_anomalies, lambda stg, layout: loiter.vessel_loitering(stg),
                  activity.vessel_activity_summary, lambda stg, layout: risk.vessel_roster(stg)):
        plan = staged.each(lambda stg, layout: model(stg, layout=layout))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(mmsi" not in plan and plan.count("FileScan") == 1
    score = frames.risk._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mmsi" not in score


def test_staging_of_hot_vessels(spark, frames):
    """Hot vessels are kept apart from the buckets, and the models find the same in both."""
    from wakeline.operators.sequence import track_layout
    from wakeline.plans import dark
    from wakeline.plans.staged import write_staging

    stg = frames.stg
    layout = track_layout(stg, "mmsi", "event_timestamp", rows_per_window=stg.groupBy("mmsi").count().agg(F.max("count")).first()[0] - 1)
    staged = write_staging(stg, layout)
    assert 0 < staged.hot.select("mmsi").distinct().count() < stg.select("mmsi").distinct().count()
    found = staged.each(lambda rows, how: dark.vessel_dark_events(rows, layout=how))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, frames.dark.select(found.columns).collect()))
    staged.remove()


def test_refresh_waits_for_fresh_silver(spark, root):
    later = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(hours=9)
    assert refresh_gold(spark, root[0], now=later) == {"status": "skipped"}


def test_refresh_of_a_day_without_ships(spark, root, tmp_path):
    """Coast stations alone: every model is empty, nothing fails."""
    path = str(tmp_path)
    shutil.copytree(f"{root[0]}/silver/metadata", f"{path}/silver/metadata")
    stations = spark.read.parquet(f"{root[0]}/silver/positions").limit(20).withColumn("mmsi", F.concat(F.lit("00"), F.substring("mmsi", 3, 7)))
    stations.write.partitionBy("partition_date").parquet(f"{path}/silver/positions")
    assert refresh_gold(spark, path, as_of="2024-01-04")["status"] == "refreshed"


def test_layer_views(spark, root, tmp_path):
    path = str(tmp_path)
    shutil.copytree(f"{root[0]}/silver", f"{path}/silver")
    for table, (columns, partitions) in (("positions", schemas.LAYERS["bronze_positions"]), ("metadata", schemas.LAYERS["bronze_metadata"])):
        spark.createDataFrame([], schemas.ddl(columns + partitions)).write.parquet(f"{path}/bronze/{table}")
    assert register_layers(spark, path) == list(schemas.LAYERS)
    assert spark.sql("select count(*) from silver_positions where partition_date = date'2024-01-02'").first()[0] > 0
    assert spark.table("bronze_positions").columns == schemas.names(sum(schemas.LAYERS["bronze_positions"], []))
