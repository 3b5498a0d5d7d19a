"""Per-provider switches."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    name: str
    # Detect "cancelled but substitute running" from remarks
    substitute_detection: bool = True
    # A3/A4: reduce the latest-sample ttl bucket in by_hour/by_day/by_station
    reduced_latest_ttl: bool = False
    # Hour pre-aggregation, line/station/operator forced NULL, no by_station
    gtfs_rollup: bool = False
    # Which histogram the "without time" roll-up reads
    without_time_source: str = "by_hour"


DE_DB = Profile("de_db")
CH_SBB = Profile("ch_sbb", substitute_detection=False, reduced_latest_ttl=True)
DE_GTFS = Profile("de_gtfsde", substitute_detection=False, gtfs_rollup=True, without_time_source="by_day")

PROFILES = {p.name: p for p in (DE_DB, CH_SBB, DE_GTFS)}
