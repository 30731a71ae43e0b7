"""Which source feeds which table: family x geography -> locations, target, declared layout.

``run_pipeline`` is the one entry for all of them: it looks at the target, picks the history
file for an empty table and the current file otherwise, runs the family, and leaves its row
in the ledger.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from hearth.plans import families as fam
from hearth.plans import specs as S
from hearth.quality.ledger import LoadEntry, entry_of, run_id_of
from hearth.sinks import GateResult, latest_loaded

# Families whose target is partitioned by a period: its column and type.
GATED = {"inventory": ("month_date_yyyymm", "int"), "hotness": ("month_date_yyyymm", "int"), "tracker": ("period_begin", "date")}


@dataclass(frozen=True)
class PipelineSpec:
    """One source. ``history`` and ``current`` are landing locations below a root; a family
    that publishes one file has it as both. ``latest_only`` families append only the newest
    period of a file that repeats all of them. ``labels``: {series label: location}."""
    family: str
    geography: str
    table: str
    history: str
    current: str
    latest_only: bool = False
    labels: tuple[tuple[str, str], ...] = ()
    dataset_type: str = ""
    state: str | None = None


def _monthly(family: str, geographies: dict[str, S.Geography], split: bool) -> list[PipelineSpec]:
    out = []
    for name, geo in geographies.items():
        at = f"{family}/{name}"
        out.append(PipelineSpec(family, name, geo.table, f"{at}/history", f"{at}/current" if split else f"{at}/history",
                                latest_only=not split))
    return out


def _series(family: str, table: str, dataset_type: str, state: str | None) -> PipelineSpec:
    labels = tuple((text, f"{family}/series_{key}") for key, text, kind in S.SERIES_LOOKUP if kind == dataset_type)
    return PipelineSpec(family, "zip", table, family, family, labels=labels, dataset_type=dataset_type, state=state)


def registry(home_state: str | None = "MA") -> dict[tuple[str, str], PipelineSpec]:
    """All sources by (family, geography). Inventory publishes a current file beside its history;
    hotness and tracker publish one file with all periods."""
    specs = _monthly("inventory", S.INVENTORY_GEOGRAPHIES, True) + _monthly("hotness", S.HOTNESS_GEOGRAPHIES, False)
    specs += [PipelineSpec("tracker", g, table, f"tracker/{g}", f"tracker/{g}", latest_only=True)
              for g, table in S.TRACKER_GEOGRAPHIES.items()]
    specs += [_series("home_values", "ZW_HOME_VALUES", "Home_Values", home_state), _series("rent_values", "ZW_RENT_VALUES", "Rent_Values", None),
              PipelineSpec("investor", "metro", "REDFIN_INVESTOR_BY_QUARTER", "investor", "investor"),
              PipelineSpec("weekly", "county", "REDFIN_WEEKLY", "weekly", "weekly")]
    return {(s.family, s.geography): s for s in specs}


def declared_layout(spec: PipelineSpec) -> list[tuple[str, str]]:
    """The declared target layout: column names, SQL types, text lengths.

    Inventory measures are whole numbers but for the pending ratio."""
    lengths = S.TEXT_LENGTHS.get("REDFIN_MNTHLY_HOUSING" if spec.family == "tracker" else spec.table, {})
    if spec.family == "inventory":
        geo = S.INVENTORY_GEOGRAPHIES[spec.geography]
        measures = [f"{m}{s}" for s in ("", "_ly", "_lm") for m in S.INVENTORY_MEASURES]
        measures.insert(len(S.INVENTORY_MEASURES), "quality_flag")
        columns = [("month_date_yyyymm", "int"), *geo.keys,
                   *((m, "double" if m.startswith("pending_ratio") else "int") for m in measures), ("Update_Date", "timestamp_ntz")]
    elif spec.family == "hotness":
        columns = fam.hotness_layout(S.HOTNESS_GEOGRAPHIES[spec.geography])
    elif spec.family == "tracker":
        columns = fam.tracker_layout()
    else:
        raise ValueError(f"no declared layout for {spec.family}")
    return [(c, f"varchar({lengths[c]})" if c in lengths else t) for c, t in columns]


def _location(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def choose_source(spark: SparkSession, spec: PipelineSpec, lake: str) -> tuple[str, str]:
    """('history' or 'current', location): history feeds a table in which nothing is loaded."""
    period, dtype = GATED[spec.family]
    empty = latest_loaded(spark, _location(lake, spec.table), period, dtype) is None
    return ("history", spec.history) if empty else ("current", spec.current)


def run_pipeline(spark: SparkSession, spec: PipelineSpec, run_ts: _dt.datetime, landing: str, lake: str,
                 fill: bool = True) -> LoadEntry | DataFrame:
    """Run one source from its landing location into its table; tables, quarantine and ledger
    lie below ``lake``. Returns the ledger's entry (the transformed rows for ``weekly``,
    which has no table)."""
    records = {"quarantine_path": _location(lake, "quarantine", spec.table), "ledger_path": _location(lake, "ledger")}
    target = _location(lake, spec.table)
    if spec.family in GATED:
        step, where = choose_source(spark, spec, lake)
        source = _location(landing, where)
        latest = spec.latest_only and step == "current"
        if spec.family == "inventory":
            result: GateResult = fam.run_inventory(spark, spec.geography, source, target, run_ts, step=step, fill=fill, **records)
        elif spec.family == "hotness":
            result = fam.run_hotness(spark, spec.geography, source, target, run_ts, latest, step=step, fill=fill, **records)
        else:
            result = fam.run_tracker(spark, source, target, run_ts, latest, step=step, geography=spec.geography, **records)
        return result.entry
    if spec.labels:
        labels = {label: _location(landing, at) for label, at in spec.labels if _landed(spark, _location(landing, at))}
        series = S.SeriesSpec(spec.dataset_type, labels, spec.state, spec.table)
        fam.run_series(spark, series, run_ts.date(), target, _location(lake, "LKP_ZW_ZIP_LOCATION_ARCHIVE"), **records)
        day = _dt.datetime.combine(run_ts.date(), _dt.time())
        entries = [entry_of(spark, records["ledger_path"], spec.table, run_id_of(day), label) for label in labels]
        return [e.asDict() for e in entries]
    if spec.family == "investor":
        fam.run_investor(spark, _location(landing, spec.history), target, run_ts, step="replace", **records)
        return entry_of(spark, records["ledger_path"], spec.table, run_id_of(run_ts), "replace")
    return fam.run_weekly(spark, _location(landing, spec.history), run_ts, step="returned", **records)


def _landed(spark: SparkSession, path: str) -> bool:
    from hearth.sinks import table_exists
    return table_exists(spark, path)
