"""Per-vessel alerts on a stream, with the last position of each vessel as state."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wakeline import refdata as ref
from wakeline import schemas
from wakeline.functions.clean import clean_sog
from wakeline.functions.timeparts import normalize_time
from wakeline.plans.alerts import has_coordinates
from wakeline.sources.streams import to_keyed_json

TRIGGER = "30 seconds"
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
#: What a query with state of this kind is started with. Its rows are sorted within partitions, so that a vessel's rows
#: come in time order; the check that refuses any sort on a stream takes that for a sort of the whole stream.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.unsupportedOperationCheck": "false",
}


# The state function runs in Python workers that may not have this package: it travels by value, and needs only plain
# values besides numpy and pandas.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
RADIUS_NM = ref.EARTH_RADIUS_KM / ref.KM_PER_NAUTICAL_MILE
SPEED_LIMIT, SPOOFING, SUDDEN = ref.ALERT_SPEED_LIMIT_KNOTS, ref.SPOOFING_SPEED_CHANGE, ref.SUDDEN_SPEED_CHANGE


#: The columns of a track and their types.
TRACK = {"lat": "float64", "lon": "float64", "sog": "float64", "micros": "int64"}


def _nautical_miles(lat1, lon1, lat2, lon2):
    phi1, phi2 = np.radians(lat1), np.radians(lat2)
    chord = np.sin((phi2 - phi1) / 2) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_NM * np.arcsin(np.sqrt(np.minimum(chord, 1.0)))


def score_track(track: pd.DataFrame, silence_min: float | None = None) -> pd.DataFrame:
    """Alerts of one vessel's rows in order, every row against the one before it.

    With ``silence_min`` a longer way in time is a silence, told with the position before it, and nothing else.
    """
    return _scored(*(track[c].to_numpy(kind) for c, kind in TRACK.items()), silence_min)


def _scored(lat, lon, sog, micros, silence_min: float | None) -> pd.DataFrame:
    """Plain arrays: a call is for one vessel, and most have few rows, so what counts is the cost of a call."""
    passed = np.diff(micros)
    hours = passed / 3.6e9
    with np.errstate(divide="ignore", invalid="ignore"):
        knots = _nautical_miles(lat[:-1], lon[:-1], lat[1:], lon[1:]) / hours
    change = np.abs(np.diff(sog))
    change[np.isnan(change)] = 0.0
    over = knots > SPEED_LIMIT
    silent = np.zeros(len(passed), bool) if silence_min is None else passed > silence_min * 6e7
    at = np.flatnonzero((hours > 0) & (silent | over | (change > SUDDEN) | (over & (change > SPOOFING))))
    kind, severity, text, place = [], [], [], []
    for i in at.tolist():
        reported = sog[i + 1]
        if silent[i]:
            kind.append("AIS_GAP")
            text.append(silence_text(silence_min, _as_text(micros[i])))
        else:
            kind.append(("GPS_SPOOFING" if change[i] > SPOOFING else "IMPOSSIBLE_SPEED") if over[i] else "SUDDEN_ACCELERATION")
            text.append(f"calculated_speed={knots[i]:.1f}kn reported_sog={None if np.isnan(reported) else float(reported)}kn speed_change={change[i]:.1f}kn")
        severity.append("medium" if kind[-1] in ("SUDDEN_ACCELERATION", "AIS_GAP") else "high")
        place.append(i if silent[i] else i + 1)
    return pd.DataFrame({
        "alert_type": kind, "severity": severity, "description": text, "latitude": lat[place] if place else lat[:0],
        "longitude": lon[place] if place else lon[:0],
    })


def silence_text(minutes: float, seen: str) -> str:
    return f"No messages for >{minutes} min — last seen at {seen}"


def _now() -> str:
    return pd.Timestamp.now("UTC").isoformat()


def _as_micros(text: str) -> int:
    return pd.Timestamp(text).value // 1000


def _as_text(micros: int) -> str:
    return pd.Timestamp(int(micros), unit="us", tz="UTC").isoformat()


def vessel_rule(timeout_min: float, arrival_order: bool, event_time: bool = False) -> Callable:
    """The state function: one call per vessel and micro-batch, and one when its timer runs out.

    Frames come in time order (or as they arrived, with ``arrival_order``) and are looked at one by one: what is held
    of a vessel is one frame and its last position. The state is read and written once for each call.
    """
    columns = schemas.names(schemas.ALERTS)
    timeout_ms = timeout_min * 60 * 1000

    def finish(mmsi: str, alerts: pd.DataFrame) -> pd.DataFrame:
        return alerts.assign(mmsi=mmsi, detected_at=_now())[columns]

    def gap(mmsi: str, state) -> Iterator[pd.DataFrame]:
        if state.exists:
            lat, lon, _, seen = state.get
            yield finish(mmsi, pd.DataFrame({
                "alert_type": ["AIS_GAP"], "severity": ["medium"], "description": [silence_text(timeout_min, seen)],
                "latitude": [lat], "longitude": [lon],
            }))
            state.remove()

    def on_vessel(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        (mmsi,) = key
        if state.hasTimedOut:
            yield from gap(mmsi, state)
            return
        last, reached, touched = None, None, False
        known = state.get if state.exists else None
        if known is not None:
            last = (known[0], known[1], np.nan if known[2] is None else known[2], _as_micros(known[3]))
        for frame in frames:
            track = [frame[c].to_numpy(kind) for c, kind in TRACK.items()]
            micros = track[3]
            if not arrival_order and len(micros):
                if (np.diff(micros) < 0).any() or (reached is not None and micros[0] < reached):
                    raise RuntimeError("the rows of a vessel did not come in time order")
                reached = micros[-1]
                if last is not None:
                    newer = micros > last[3]
                    track = [c[newer] for c in track]
            if not len(track[0]):
                continue
            if last is not None:
                track = [np.concatenate([np.array([v], c.dtype), c]) for v, c in zip(last, track)]
            last, touched = tuple(c[-1] for c in track), True
            alerts = _scored(*track, timeout_min if event_time else None)
            if len(alerts):
                yield finish(mmsi, alerts)
        if touched:
            lat, lon, sog, seen = last
            state.update((float(lat), float(lon), None if np.isnan(sog) else float(sog), _as_text(seen)))
            state.setTimeoutDuration(timeout_ms)

    return on_vessel


class VesselState:
    """One vessel's value state and its timer, for one call of the rule.

    The timer counts from now, or in event time from the last position.
    """

    def __init__(self, handle, value, now_ms: int | None, timed_out: bool = False):
        self.handle, self.value, self.now_ms, self.hasTimedOut = handle, value, now_ms, timed_out

    @property
    def exists(self) -> bool:
        return self.value.exists()

    @property
    def get(self) -> tuple:
        return self.value.get()

    def update(self, last: tuple) -> None:
        self.value.update(last)

    def remove(self) -> None:
        self.value.clear()

    def setTimeoutDuration(self, ms: float) -> None:  # noqa: N802 - the name that group states have
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        since = _as_micros(self.get[3]) // 1000 if self.now_ms is None else self.now_ms
        self.handle.registerTimer(int(since + ms))


class VesselProcessor(StatefulProcessor):
    """The rule as a processor of a keyed stream: the last position in a value state, silence by a timer."""

    def __init__(self, rule: Callable, event_time: bool):
        self.rule, self.event_time, self.fields = rule, event_time, schemas.ddl(schemas.ALERT_STATE)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", self.fields)

    def _state(self, timers, timed_out: bool) -> VesselState:
        now = None if self.event_time else timers.getCurrentProcessingTimeInMs()
        return VesselState(self.handle, self.last, now, timed_out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        return self.rule(key, rows, self._state(timerValues, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        return self.rule(key, iter(()), self._state(timerValues, True))

    def close(self) -> None:
        pass


def vessel_alerts(
    stream: DataFrame, timeout_min: float = ref.SILENCE_MINUTES, arrival_order: bool = False, delay: str | None = None
) -> DataFrame:
    """Alerts from a stream of (MMSI, Latitude, Longitude, Sog, time_utc text).

    Cleaning runs as Column expressions before the shuffle. Rows of one micro-batch are sorted by vessel and time on
    their way to the state, and older rows than the known position are passed over; ``arrival_order=True`` takes rows
    as they come instead.

    Silence is told by the clock when nothing came for ``timeout_min``. With ``delay``, how late rows may be, it is told
    in event time: when the watermark has passed a vessel's last position by that, or its next row lies further on. The
    vessel's track then starts anew. So the alerts do not depend on when and in how many batches the rows are read, and
    a drained run tells those that fell silent. Start the result with ``start_alert_stream``.
    """
    at = normalize_time(F.col("time_utc"))
    usable = stream.select(
        F.col("MMSI").alias("mmsi"), F.col("Latitude"), F.col("Longitude"), clean_sog(F.col("Sog")).alias("sog"), at.alias("at"),
    ).filter(has_coordinates() & F.col("at").isNotNull())
    if delay is not None:
        usable = usable.withWatermark("at", delay)
    rows = usable.select(
        "mmsi", F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"), "sog", F.unix_micros("at").alias("micros"),
        *([] if delay is None else ["at"]),
    )
    if not arrival_order:
        rows = rows.repartition("mmsi").sortWithinPartitions("mmsi", "micros")
    event_time = delay is not None
    return rows.groupBy("mmsi").transformWithStateInPandas(
        VesselProcessor(vessel_rule(timeout_min, arrival_order, event_time), event_time),
        schemas.ddl(schemas.ALERTS), "append", "EventTime" if event_time else "ProcessingTime",
    )


def start_alert_stream(
    alerts: DataFrame, sink: str, checkpoint: str, *, trigger: dict | None = None, name: str | None = "hot_alerts",
    keyed_json: bool = True, event_time: bool = False, **options: str,
) -> StreamingQuery:
    """Write alerts as keyed JSON (or as columns) to ``sink``, appending.

    A drained run (``availableNow``) goes without no-data batches unless silence is told in ``event_time``: with timers
    of the clock they would follow each other for as long as any vessel has one, and the run would never end.
    """
    rows = to_keyed_json(alerts, "mmsi") if keyed_json else alerts
    writer = rows.writeStream.format(sink).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.options(**options).trigger(**(trigger or {"processingTime": TRIGGER}))
    settings = dict(STATE_SETTINGS)
    if (trigger or {}).get("availableNow") and not event_time:
        settings[NO_DATA_BATCHES] = "false"
    conf = alerts.sparkSession.conf
    before = {key: conf.get(key) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        return writer.start()  # the query keeps the settings it was started with
    finally:
        for key, value in before.items():
            conf.set(key, value)
