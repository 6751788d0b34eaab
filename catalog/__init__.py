"""Registered queries: each operator applied to the supplied tables, with its SQL counterpart."""

from __future__ import annotations

from catalog import forecasts, models, profiles, quality, replenishment, sources

_AREAS = (sources, models, profiles, quality, forecasts, replenishment)
ENTRIES = {name: entry for area in _AREAS for name, entry in area.ENTRIES.items()}


def queries() -> dict:
    return {name: run for name, (run, _) in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for name, (_, text) in ENTRIES.items() if text is not None}
