"""Loads of the warehouse: reserved numbers, and versions that say which of them count.

A load's rows lie in ``load=<number>`` folders. ``_loads/<number>`` reserves a number before
anything is written; ``_versions/<number>`` publishes a load, in one step, with all its tables.
Readers take the newest version: rows of loads that died, are under way or lost a race are never
seen. Of two loads that began at the same version one gets the next, the other is refused and its
rows stay unseen; its run fails and the next one takes them up again.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.sources.markers import create_once, marker_names, read_marker

LOAD = "load"


class LoadConflict(RuntimeError):
    """Another load was published since this one began."""


@dataclass(frozen=True)
class Snapshot:
    """Loads up to ``newest`` count, but for the ranges (first, last) in ``without``; ids from
    ``next_sales_id`` on are free."""

    version: int = 0
    newest: int = 0
    without: tuple[tuple[int, int], ...] = ()
    next_sales_id: int = 1

    def counts(self) -> Column:
        """The test for rows of published loads; on a partition column, so folders are pruned."""
        load = F.col(LOAD)
        return reduce(lambda test, gap: test & ~load.between(*gap), self.without, load <= self.newest)


def _numbered(folder: str, number: int) -> str:
    return f"{folder}/{number:010d}"


def read_snapshot(spark: SparkSession, warehouse: str) -> Snapshot:
    versions = marker_names(spark, f"{warehouse}/_versions")
    if not versions:
        return Snapshot()
    told = json.loads(read_marker(spark, f"{warehouse}/_versions/{versions[-1]}"))
    return Snapshot(**told | {"without": tuple(map(tuple, told["without"]))})


def reserve_load(spark: SparkSession, warehouse: str, run_id: str) -> int:
    """A number of one's own; one that is not used leaves a gap."""
    folder = f"{warehouse}/_loads"
    number = int((marker_names(spark, folder) or ["0"])[-1]) + 1
    while not create_once(spark, _numbered(folder, number), run_id):
        number += 1
    return number


def load_runs(spark: SparkSession, warehouse: str) -> dict[int, str]:
    """Run id of each reserved load."""
    folder = f"{warehouse}/_loads"
    return {int(n): read_marker(spark, f"{folder}/{n}") for n in marker_names(spark, folder)}


def publish(spark: SparkSession, warehouse: str, base: Snapshot, load: int, sales: int) -> Snapshot:
    """Make a load that began at ``base`` count. Unpublished loads between never will."""
    gap = ((base.newest + 1, load - 1),) if load > base.newest + 1 else ()
    new = Snapshot(base.version + 1, load, base.without + gap, base.next_sales_id + sales)
    path = _numbered(f"{warehouse}/_versions", new.version)
    if not create_once(spark, path, json.dumps(asdict(new))):
        raise LoadConflict(f"load {load}: another load was published as version {new.version}")
    return new


def of_load(rows: DataFrame, load: int) -> DataFrame:
    return rows.withColumn(LOAD, F.lit(load))
