"""Named output datasets (A15): name -> builder, inputs, output mode, comment.

The source pipeline declares each silver/gold table with a decorator and lets
a runtime order them by the tables they read. Here the same facts are data:
``DATASETS`` lists every dataset with the datasets it reads, ``order()``
returns a dependency order, ``build()`` composes the builders over
whatever inputs (static or streaming DataFrames) the caller provides, and
``plans.jobs`` runs them through stored tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetspark.operators.expectations import ExpectationSet
from fleetspark.plans import gold, silver


@dataclass(frozen=True)
class Dataset:
    """``mode``: "append" (stateless or watermarked), "upsert" (unbounded aggregate by ``keys``, whose changed groups are replaced),
    "complete" (replaced as a whole) or "scd2" (versions). ``joined_by``: the key by which a stream's second input is read.
    ``snapshots``: the inputs that a stream reads as they stand (the static side of its joins).
    ``rules`` and ``prepared``: the rule set and the rows it is applied to, where the builder applies one."""

    name: str
    builder: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    mode: str
    comment: str
    job: str
    snapshots: tuple[str, ...] = ()
    rules: ExpectationSet | None = None
    prepared: Callable[..., DataFrame] | None = None
    keys: tuple[str, ...] = ()
    joined_by: str | None = None

    @property
    def layer(self) -> str:
        return self.name.rsplit("_", 1)[1]


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in [
        Dataset("gps_events_silver", silver.gps_events_silver, ("gps_events",), "append",
                "Position pings within bounds, one per trip and time.", "stream",
                rules=silver.GPS_RULES, prepared=silver.gps_events_prepared),
        Dataset("sensor_events_silver", silver.sensor_events_silver, ("sensor_events",), "append",
                "Sensor readings within bounds, one per trip and time, anomalies flagged.", "stream",
                rules=silver.SENSOR_RULES, prepared=silver.sensor_events_prepared),
        Dataset("delivery_events_silver", silver.delivery_events_silver, ("delivery_events",), "append",
                "Delivery updates with a known status and its rank.", "stream",
                rules=silver.DELIVERY_RULES, prepared=silver.delivery_events_prepared),
        Dataset("shipment_invoice_silver", silver.shipment_invoice_silver, ("shipment_manifests", "invoices"), "append",
                "Every manifest with its invoices, if any.", "batch", ("invoices",),
                silver.SHIPMENT_INVOICE_RULES, silver.shipment_invoice_prepared, joined_by="manifest_id"),
        Dataset("maintenance_logs_silver", silver.maintenance_logs_silver, ("maintenance_logs",), "append",
                "Service records with trimmed texts and positive figures.", "batch",
                rules=silver.MAINTENANCE_RULES, prepared=silver.maintenance_logs_prepared),
        Dataset("driver_vehicle_master_silver", silver.driver_vehicle_master_silver, ("driver_vehicle_master",), "scd2",
                "Versions of each vehicle's assignment from its snapshots.", "batch"),
        Dataset("daily_revenue_gold", gold.daily_revenue_gold, ("shipment_invoice_silver",), "upsert",
                "Invoiced amounts summed by day, route and priority.", "batch", keys=tuple(gold.REVENUE_KEYS)),
        Dataset("vehicle_scorecard_gold", gold.vehicle_scorecard_gold,
                ("maintenance_logs_silver", "driver_vehicle_master_silver"), "complete",
                "Service cost and count of each vehicle beside who drives it now.", "batch", ("driver_vehicle_master_silver",)),
        Dataset("active_alerts_gold", gold.active_alerts_gold, ("sensor_events_silver",), "append",
                "Readings that carry an anomaly flag.", "stream"),
        Dataset("delivery_performance_gold", gold.delivery_performance_gold, ("delivery_events_silver",), "append",
                "Delivery updates per hour and status.", "stream"),
        Dataset("fuel_cost_efficiency_gold", gold.fuel_cost_efficiency_gold,
                ("sensor_events_silver", "gps_events_silver"), "upsert",
                "Most and least fuel and distance of each trip, of vehicles seen by both kinds of events.", "stream", ("sensor_events_silver",), keys=("trip_id",)),
        Dataset("live_fleet_status_gold", gold.live_fleet_status_gold,
                ("gps_events_silver", "sensor_events_silver"), "append",
                "Every ping beside the sensor readings of its trip that lie near it in time.", "stream"),
    ]
}


def order(targets: list[str] | None = None) -> list[str]:
    """Datasets in dependency order (inputs first); raises on a cycle."""
    targets = list(DATASETS) if targets is None else targets
    done: list[str] = []
    visiting: set[str] = set()

    def visit(n: str) -> None:
        if n in done or n not in DATASETS:
            return
        if n in visiting:
            raise ValueError(f"cycle at {n}")
        visiting.add(n)
        for i in DATASETS[n].inputs:
            visit(i)
        visiting.discard(n)
        done.append(n)

    for t in targets:
        visit(t)
    return done


def build(sources: Mapping[str, DataFrame], targets: list[str] | None = None) -> dict[str, DataFrame]:
    """Compose the builders: ``sources`` maps bronze names to DataFrames;
    returns every dataset reachable from them, by name."""
    env: dict[str, DataFrame] = dict(sources)
    for n in order(targets):
        d = DATASETS[n]
        if all(i in env for i in d.inputs):
            env[n] = d.builder(*[env[i] for i in d.inputs])
    return {n: env[n] for n in DATASETS if n in env}
