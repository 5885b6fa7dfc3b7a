"""The expectation suites. FIXED VALUES: names, bounds and value lists are the agreed data tests."""

from __future__ import annotations

from wakeline.quality.expectations import (
    Rule, accepted_values, is_true, not_constant, not_null, unique, unique_combination,
)

NOT_IN_FUTURE = is_true("gold_processed_at_not_in_future", "gold_processed_at <= current_timestamp()")

SUITES: dict[str, list[Rule]] = {
    "silver_positions": not_null("mmsi", "latitude", "longitude", "event_timestamp"),
    "silver_metadata": [
        *not_null("mmsi", "processing_timestamp"),
        accepted_values(
            "vessel_type_normalized", "cargo", "tanker", "passenger", "fishing", "tug", "special_craft",
            "sailing_or_pleasure", "high_speed_craft", "wing_in_ground", "other", "unknown",
        ),
    ],
    "vessel_activity_summary": [
        *not_null("mmsi", "date_day", "position_count", "gold_processed_at"),
        not_constant("mmsi"),
        is_true("date_day_not_in_future", "date_day <= current_date()"),
        is_true("date_day_not_before_ais_era", "date_day >= date'2019-01-01'"),
        is_true("position_count_at_least_one", "position_count >= 1"),
        is_true(
            "avg_speed_knots_plausible_range",
            "avg_speed_knots is null or (avg_speed_knots >= 0 and avg_speed_knots < 60)", "warn",
        ),
        is_true("estimated_distance_km_non_negative", "estimated_distance_km is null or estimated_distance_km >= 0"),
        is_true("max_ais_gap_minutes_non_negative", "max_ais_gap_minutes is null or max_ais_gap_minutes >= 0"),
        is_true("max_ais_gap_minutes_under_30_days", "max_ais_gap_minutes is null or max_ais_gap_minutes <= 43200"),
        NOT_IN_FUTURE,
        unique_combination("mmsi", "date_day"),
    ],
    "port_traffic": [
        *not_null("port_name", "date_day", "unique_vessels", "gold_processed_at"),
        not_constant("port_name"),
        is_true("date_day_not_in_future", "date_day <= current_date()"),
        is_true("unique_vessels_at_least_one", "unique_vessels >= 1"),
        is_true("unique_vessels_realistic_cap", "unique_vessels < 5000"),
        NOT_IN_FUTURE,
        unique_combination("port_name", "date_day"),
        is_true("port_name_not_empty_string", "length(trim(port_name)) > 0"),
        is_true(
            "vessel_type_breakdown_sums_to_unique_vessels",
            "cargo_vessels + tanker_vessels + passenger_vessels + fishing_vessels + tug_vessels + special_craft_vessels"
            " + sailing_or_pleasure_vessels + high_speed_craft_vessels + other_vessels = unique_vessels",
        ),
    ],
    "vessel_erratic_course": [
        *not_null("alert_id", "mmsi", "date_day", "severity", "sharp_turns", "gold_processed_at"),
        unique("alert_id"),
        is_true("date_day_not_in_future", "date_day <= current_date()"),
        accepted_values("severity", "low", "medium", "high"),
        is_true("sharp_turns_above_detection_threshold", "sharp_turns > 10"),
        NOT_IN_FUTURE,
        unique_combination("mmsi", "date_day"),
        is_true("alert_id_is_valid_md5", "length(alert_id) = 32"),
    ],
    "vessel_dark_events": [
        *not_null(
            "dark_event_id", "mmsi", "gap_minutes", "severity", "signal_lost_at", "signal_recovered_at", "event_date"
        ),
        unique("dark_event_id"),
        is_true("gap_minutes_above_detection_threshold", "gap_minutes > 120"),
        is_true("gap_minutes_under_one_year", "gap_minutes <= 525600"),
        is_true("displacement_km_non_negative", "displacement_km is null or displacement_km >= 0"),
        is_true("displacement_km_physically_possible", "displacement_km is null or displacement_km < 20000"),
        accepted_values("severity", "CRITICAL", "HIGH", "MEDIUM"),
        is_true("recovery_after_loss", "signal_recovered_at > signal_lost_at"),
        unique_combination("mmsi", "signal_recovered_at"),
        is_true("dark_event_id_is_valid_md5", "length(dark_event_id) = 32"),
        is_true(
            "gap_minutes_consistent_with_timestamps",
            "abs(timestampdiff(MINUTE, signal_lost_at, signal_recovered_at) - gap_minutes) <= 1",
        ),
    ],
    "vessel_speed_anomalies": [
        *not_null("anomaly_id", "mmsi", "calculated_speed_knots", "anomaly_type", "event_date"),
        unique("anomaly_id"),
        is_true(
            "reported_sog_valid_ais_range", "reported_sog is null or (reported_sog >= 0 and reported_sog < 102.3)", "warn"
        ),
        is_true("calculated_speed_non_negative", "calculated_speed_knots >= 0"),
        accepted_values("anomaly_type", "GPS_SPOOFING", "IMPOSSIBLE_SPEED", "SUDDEN_ACCELERATION"),
        is_true(
            "integrity_anomaly_logic",
            "(anomaly_type in ('GPS_SPOOFING', 'IMPOSSIBLE_SPEED') and speed_excess_knots > 0)"
            " or (anomaly_type = 'SUDDEN_ACCELERATION' and speed_excess_knots is not null)",
        ),
        is_true(
            "alert_unmapped_vessel_types",
            "type_max_speed != 35.0 or vessel_type_normalized in ('other', 'unknown')", "warn",
        ),
    ],
    "vessel_loitering": [
        *not_null(
            "loiter_event_id", "mmsi", "duration_minutes", "avg_speed_knots", "risk_level", "window_start", "window_end",
            "event_date",
        ),
        unique("loiter_event_id"),
        is_true("duration_above_detection_threshold", "duration_minutes > 180"),
        is_true("avg_speed_within_loiter_band", "avg_speed_knots >= 0.1 and avg_speed_knots <= 4.0"),
        is_true("avg_heading_change_non_negative", "avg_heading_change is null or avg_heading_change >= 0"),
        accepted_values("risk_level", "HIGH", "MEDIUM", "LOW"),
        is_true("window_end_after_window_start", "window_end > window_start"),
        unique_combination("mmsi", "window_start"),
        is_true("loiter_event_id_is_valid_md5", "length(loiter_event_id) = 32"),
        is_true(
            "duration_consistent_with_timestamps",
            "abs(timestampdiff(MINUTE, window_start, window_end) - duration_minutes) <= 1",
        ),
    ],
    "vessel_risk_score": [
        *not_null("score_id", "mmsi", "risk_score", "score_date"),
        unique("score_id"),
        is_true("risk_score_positive", "risk_score > 0"),
        is_true("risk_score_realistic_cap", "risk_score < 10000"),
        is_true("score_date_not_in_future", "score_date <= current_date()"),
        is_true("spoofing_signals_non_negative", "spoofing_signals_30d >= 0"),
        is_true("dark_events_non_negative", "dark_events_30d >= 0"),
        unique_combination("mmsi", "score_date"),
        is_true("score_id_is_valid_md5", "length(score_id) = 32"),
        is_true("risk_score_reflects_spoofing_weight", "not (spoofing_signals_30d > 0 and risk_score < 15)"),
    ],
}
