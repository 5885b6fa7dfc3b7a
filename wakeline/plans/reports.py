"""Report queries over the stored layers. Every top-n has a key as tie-break."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.clean import mask_mmsi
from wakeline.functions.geo import grid_cell
from wakeline.functions.timeparts import as_timestamp, bucket_label


def _count(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def report_overview(silver: DataFrame) -> DataFrame:
    per_vessel = silver.groupBy("mmsi", "flag_country").agg(
        _count("_rows"), F.count_if("is_in_port_zone").alias("_in_port"),
        F.min("event_timestamp").alias("_from"), F.max("event_timestamp").alias("_to"),
    )
    return per_vessel.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("positions"),
        F.count_distinct("mmsi").alias("vessels"),
        F.count_distinct("flag_country").alias("flags"),
        F.coalesce(F.sum("_in_port"), F.lit(0)).alias("in_port"),
        F.min("_from").alias("first_ts"), F.max("_to").alias("last_ts"),
    )


def report_gold_totals(activity: DataFrame) -> DataFrame:
    return activity.agg(
        _count("vessel_days"), F.round(F.sum("estimated_distance_km")).alias("km"),
        F.sum("sharp_turns").alias("sharp_turns"), F.sum("sudden_speed_changes").alias("sudden_changes"),
    )


def report_table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [df.agg(_count()).select(F.lit(name).alias("t"), "n") for name, df in sorted(tables.items())]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def report_top_flags(silver: DataFrame, n: int = 10) -> DataFrame:
    flags = silver.filter(F.col("flag_country").isNotNull()).groupBy(F.col("flag_country").alias("k"))
    return flags.agg(F.count_distinct("mmsi").alias("n")).orderBy(F.desc("n"), "k").limit(n)


def report_regions(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.col("ocean_region").alias("k")).agg(_count()).orderBy(F.desc("n"), "k")


def report_types(activity: DataFrame, n: int = 8) -> DataFrame:
    return activity.groupBy(F.col("vessel_type").alias("k")).agg(_count()).orderBy(F.desc("n"), "k").limit(n)


def report_timeline(silver: DataFrame, seconds: int = 300) -> DataFrame:
    label = bucket_label(F.col("event_timestamp"), seconds).alias("t")
    return silver.groupBy(label).agg(_count()).orderBy("t")


def report_timeline_gaps(silver: DataFrame, seconds: int = 300) -> DataFrame:
    """Holes of at least one bucket. The window has no partition: it sees one row per time-of-day label."""
    minute = F.substring("t", 1, 2).cast("int") * 60 + F.substring("t", 4, 2).cast("int")
    buckets = report_timeline(silver, seconds).withColumn("_minute", minute)
    order = Window.orderBy("_minute")
    step = seconds // 60
    return (
        buckets.withColumns({"after": F.lag("t").over(order), "_last": F.lag("_minute").over(order)})
        .withColumn("gap_minutes", F.col("_minute") - F.col("_last") - step)
        .filter(F.col("gap_minutes") >= step)
        .select("after", F.col("t").alias("until"), "gap_minutes")
        .orderBy("until")
    )


def report_grid(silver: DataFrame, step: float = 2.0) -> DataFrame:
    on_globe = silver.filter(F.col("latitude").between(-90.0, 90.0) & F.col("longitude").between(-180.0, 180.0))
    return on_globe.groupBy(
        grid_cell(F.col("latitude"), step).cast("bigint").alias("la"),
        grid_cell(F.col("longitude"), step).cast("bigint").alias("lo"),
    ).agg(_count())


def report_top_ports(ports: DataFrame, n: int = 8) -> DataFrame:
    return (
        ports.orderBy(F.desc("total_position_reports"), "port_name", "date_day")
        .limit(n)
        .select(
            "port_name", "port_country", "unique_vessels", "total_position_reports", "cargo_vessels",
            "tanker_vessels", "passenger_vessels", F.round("avg_speed_in_port", 1).alias("avg_speed"),
        )
    )


def report_top_risk(risk: DataFrame, n: int = 8) -> DataFrame:
    """The riskiest vessels, numbers masked."""
    top = risk.orderBy(F.desc("risk_score"), "mmsi").limit(n)
    return top.select(
        mask_mmsi(F.col("mmsi")).alias("mmsi"), "flag_country", F.col("vessel_type_normalized").alias("t"),
        F.col("dark_events_30d").alias("dark"), F.col("speed_anomalies_30d").alias("speed"),
        F.col("spoofing_signals_30d").alias("spoof"), F.col("loiter_events_30d").alias("loiter"), "risk_score",
    )


def report_risk_histogram(risk: DataFrame) -> DataFrame:
    return risk.groupBy(F.col("risk_score").alias("k")).agg(_count()).orderBy("k")


def report_anomaly_buckets(speed: DataFrame) -> DataFrame:
    knots = F.col("calculated_speed_knots")
    label = (
        F.when(knots < 35, "14-35 kn").when(knots < 100, "35-100 kn").when(knots < 1000, "100-1,000 kn")
        .otherwise("over 1,000 kn")
    )
    return speed.groupBy(label.alias("k")).agg(_count(), F.min(knots).alias("lo")).orderBy("lo")


def fastest_anomaly(speed: DataFrame) -> DataFrame:
    return (
        speed.orderBy(F.desc("calculated_speed_knots"), "mmsi", "event_timestamp")
        .limit(1)
        .select("mmsi", "event_timestamp", "calculated_speed_knots")
    )


def points_before(silver: DataFrame, events: DataFrame, seconds: int = 60, n: int = 2) -> DataFrame:
    """The last ``n`` positions of the event's vessel in the ``seconds`` up to the event. ``events`` holds one row."""
    at = F.col("e.event_timestamp")
    window = F.col("p.event_timestamp").between(at - F.expr(f"interval {int(seconds)} seconds"), at)
    one_event = F.broadcast(events.limit(1).alias("e"))  # exactly one row
    return (
        silver.alias("p").join(one_event, (F.col("p.mmsi") == F.col("e.mmsi")) & window)
        .orderBy(F.desc("p.event_timestamp")).limit(n)
        .select("p.*", F.col("e.calculated_speed_knots"))
    )


def report_case_file(speed: DataFrame, silver: DataFrame) -> DataFrame:
    """The fastest anomaly and the positions that produced it, oldest first."""
    pair = points_before(silver, fastest_anomaly(speed))
    return pair.select(
        mask_mmsi(F.col("mmsi")).alias("mmsi"), F.round("calculated_speed_knots").alias("speed_knots"),
        F.col("event_timestamp").alias("ts"), F.round("latitude", 3).alias("lat"), F.round("longitude", 3).alias("lon"),
        F.col("speed_over_ground").alias("sog"), F.col("navigational_status").alias("status"),
    ).orderBy("ts")


def newest_alerts(alerts: DataFrame, last_n: int) -> DataFrame:
    return alerts.orderBy(F.desc("detected_at"), "mmsi", "alert_type").limit(last_n)


def alerts_by_type(alerts: DataFrame, last_n: int = 50) -> DataFrame:
    return newest_alerts(alerts, last_n).groupBy("alert_type").agg(_count()).orderBy(F.desc("n"), "alert_type")


def latest_alerts(alerts: DataFrame, last_n: int = 50, n: int = 8) -> DataFrame:
    """The ``n`` newest of the last ``last_n`` alerts."""
    return newest_alerts(alerts, min(n, last_n)).select(
        "detected_at", "alert_type", "severity", "mmsi", "description", "latitude", "longitude"
    )


def layer_gap(audit: DataFrame, minutes: int = 15, as_of=None, layer: str = "bronze_positions") -> DataFrame:
    """Share of read rows not written over the last ``minutes``: max(0, 1 - out/in), null without traffic.

    Messages of other kinds, where the audit tells them, are not counted as read.
    """
    until = as_timestamp(as_of)
    recent = audit.filter(
        (F.col("layer") == layer)
        & (F.col("finished_at") > until - F.expr(f"interval {int(minutes)} minutes"))
        & (F.col("finished_at") <= until)
    )
    own = F.col("rows_read") - F.col("rows_other") if "rows_other" in audit.columns else F.col("rows_read")
    sums = recent.agg(F.sum(own).alias("rows_read"), F.sum("rows_written").alias("rows_written"))
    share = F.lit(1.0) - F.try_divide("rows_written", "rows_read")
    return sums.withColumn("gap", F.when(share < 0, F.lit(0.0)).otherwise(share))
