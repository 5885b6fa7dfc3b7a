"""The whole chain through the command line, on folders."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from wakeline import jobs
from wakeline.sources import snapshots


def test_chain(spark, tmp_path, capsys):
    begin = datetime(2024, 5, 1, tzinfo=timezone.utc)
    texts = []
    for vessel in range(4):
        for i in range(20):
            texts.append(json.dumps({
                "Message": {"PositionReport": {
                    "Latitude": 51.5 + 0.1 * (i % 7) + 1.6 * (vessel % 2), "Longitude": 4.0 + 5.8 * (vessel % 2), "Sog": 12.0 * (i % 3), "Cog": 10.0,
                    "TrueHeading": i * 50 % 360, "NavigationalStatus": 0}},
                "MessageType": "PositionReport",
                "MetaData": {"MMSI": 244000001 + vessel, "ShipName": "S", "time_utc": (begin + timedelta(minutes=150 * i)).isoformat()},
            }))
    static = json.dumps({"Message": {"ShipStaticData": {"Type": 70, "Name": "N"}}, "MessageType": "ShipStaticData", "MetaData": {"MMSI": 244000001}})
    for name, lines in (("raw", texts), ("static", [static])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "0.json").write_text("\n".join(lines) + "\n")
    lake, topic, static_topic = (str(tmp_path / d) for d in ("lake", "topic", "static_topic"))

    def stream(job, source, output, sink=None):
        args = [job, "--source", "text", "--path", source, "--output", output, "--checkpoint", f"{output}-cp", "--once",
                "--audit", f"{lake}-audit"]
        jobs.main(args + (["--sink", "json", "--sink-option", f"path={sink}"] if sink else []))

    def values(folder):
        """The value column of a topic kept as JSON lines."""
        out = f"{folder}-values"
        spark.read.json(folder).select("value").write.text(out)
        return out

    stream("bronze-positions", str(tmp_path / "raw"), f"{lake}/bronze/positions", topic)
    stream("bronze-metadata", str(tmp_path / "static"), f"{lake}/bronze/metadata", static_topic)
    stream("silver-positions", values(topic), f"{lake}/silver/positions")
    stream("silver-metadata", values(static_topic), f"{lake}/silver/metadata")
    assert spark.read.parquet(f"{lake}/silver/positions").count() == 80
    jobs.main(["refresh", "--root", lake, "--as-of", "2024-05-03"])
    jobs.main(["compact", "--base", f"{lake}/silver", "--dataset", "positions", "--date", "2024-05-01", "--min-files", "1"])
    assert snapshots.read(spark, f"{lake}/silver/positions").count() == 80
    jobs.main(["sql", "--root", lake, "select mmsi, count(*) as days from vessel_activity_summary group by mmsi order by mmsi limit 1"])
    jobs.main(["report", "--root", lake])
    jobs.main(["profile", "--path", f"{lake}/bronze/positions"])
    jobs.main(["duplicates", "--root", lake])
    jobs.main(["alerts", "--source", "text", "--path", str(tmp_path / "topic-values"), "--checkpoint", f"{lake}-acp", "--once",
               "--sink", "json", "--sink-option", f"path={lake}/alerts"])
    shown = capsys.readouterr().out
    assert "|244000001|2   |" in shown
    assert '"status": "refreshed"' in shown and '"status": "compacted"' in shown and "anomaly buckets" in shown
    assert spark.read.json(f"{lake}/alerts").count() > 0


def test_bad_arguments():
    with pytest.raises(SystemExit):
        jobs.main(["compact", "--base", "x", "--date", "yesterday"])


def test_refresh_refuses_a_layer_that_is_not_as_declared(spark, tmp_path):
    folder = str(tmp_path / "silver/positions")
    spark.range(3).selectExpr("cast(id as string) as mmsi", "date'2024-05-01' as partition_date").write.partitionBy("partition_date").parquet(folder)
    with pytest.raises(SystemExit, match="silver positions: missing column vessel_name"):
        jobs.main(["refresh", "--root", str(tmp_path), "--any-age"])


def test_streams_that_wait_for_late_rows(spark, tmp_path):
    """The alert job tells silence in event time, the silver job knows copies of other batches."""
    begin = datetime(2024, 5, 1, tzinfo=timezone.utc)
    rows = [{"MMSI": str(v), "Latitude": 1.0, "Longitude": 2.0, "Sog": 5.0, "time_utc": (begin + timedelta(minutes=m)).isoformat()}
            for v, m in ((1, 0), (2, 0), (2, 200), (2, 300))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    jobs.main(["alerts", "--source", "text", "--path", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "cp"), "--once",
               "--delay", "1 minute", "--sink", "json", "--sink-option", f"path={tmp_path}/alerts"])
    sent = [json.loads(r["value"]) for r in spark.read.json(str(tmp_path / "alerts")).collect()]
    assert sorted((a["mmsi"], a["alert_type"]) for a in sent) == [("1", "AIS_GAP"), ("2", "AIS_GAP")]
