"""State of orders at a time from snapshots and the tail of the event log.

The log is a table partitioned by month. At the end of every ``every``-th month of a year a snapshot
holds the fold of all events until then. A read takes the last snapshot before its time and
the months of the log after it, so its work is the tail and one row per order, whatever the
length of the history. Folds are minima and maxima: an event that is loaded twice, or
stands in a snapshot and in the tail, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailflow.functions.time import time_literal
from retailflow.operators.lifecycle import event_folds, fold_measures, folded_state, merge_folds
from retailflow.sinks.folders import Folders, fresh


class StateSnapshots:
    """An event log below ``root`` with its snapshots; ``every`` divides 12 months."""

    def __init__(self, spark: SparkSession, root: str, every: int = 3) -> None:
        if every < 1 or 12 % every:
            raise ValueError("every must divide 12")
        self.spark, self.root, self.every = spark, root.rstrip("/"), every
        self.log, self.taken = f"{self.root}/log", f"{self.root}/snapshots"

    def append(self, events: DataFrame) -> list[int]:
        """Add events, late ones too, and take the snapshots that they change; returns their months.

        Events are written once, apart, and their months tell which snapshots no longer hold. Those
        go first, then the files join the log, then snapshots are taken again from the last one
        that holds. A load that stops at any point leaves a log that is read right, only longer,
        and may be run again.
        """
        rows = events.filter(F.col("timestamp").isNotNull()).withColumn("month", _month(F.col("timestamp")))
        folders = Folders(self.spark, self.root)
        if not folders.exists(self.log):
            # No rows, but the columns, for a log that never gets any.
            rows.drop("month").limit(0).write.parquet(f"{self.log}/month=0")
        staged = fresh(self.root, "staged")
        try:
            # Few files a month; a month that holds most rows is split over tasks.
            rows.hint("rebalance", "month").write.partitionBy("month").parquet(staged)
            come = _months(folders.names(staged))
            if not come:
                return []
            for month in self.snapshots():
                if month >= come[0]:
                    folders.delete(f"{self.taken}/{month}")
            folders.add(staged, self.log)
        finally:
            folders.delete(staged)
        self.spark.catalog.refreshByPath(self.log)
        return self.refresh()

    def refresh(self) -> list[int]:
        """Take the snapshots that are due, all from the last one before them and the months since.

        Every order goes through one window over its events: the running fold at an event holds
        until the order's next event, so it goes into the snapshots that end between the two.
        """
        folders = Folders(self.spark, self.root)
        months = self.months()
        held = self.snapshots()
        ends = {self._end(m) for m in months if self._end(m) < months[-1]}
        due = sorted(ends.difference(held))
        if not due:
            return due
        folds = self._parts(due[0], due[-1])
        order = Window.partitionBy("order_id").orderBy("month")
        running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        measures = fold_measures()
        rows = folds.select(
            "order_id",
            *[value.over(running).alias(c) for c, value in measures.items()],
            "month",
            F.lead("month").over(order).alias("until"),
        )
        holds = lambda end: (end >= F.col("month")) & (F.col("until").isNull() | (end < F.col("until")))
        ended = F.explode(F.filter(F.array(*map(F.lit, due)), holds)).alias("end")
        taken = rows.select("order_id", *measures, ended)
        staged = fresh(self.taken, "staged")
        try:
            taken.write.partitionBy("end").parquet(staged)
            for end in due:
                folders.move(f"{staged}/end={end}", f"{self.taken}/{end}")
        finally:
            folders.delete(staged)
        return due

    def months(self) -> list[int]:
        """Months of the log that hold events."""
        return _months(Folders(self.spark, self.root).names(self.log))

    def snapshots(self) -> list[int]:
        """Last months of the snapshots."""
        return sorted(int(n) for n in Folders(self.spark, self.root).names(self.taken) if n.isdigit())

    def as_of(self, at: str) -> DataFrame:
        """Order rows as they were at time ``at``, equal to ``lifecycle.state_as_of`` of all events."""
        moment = self.spark.range(1).select(_month(F.lit(at).cast("timestamp_ntz"))).first()[0]
        return folded_state(merge_folds(self._parts(moment, moment, at).drop("month")))

    def _parts(self, before: int, until: int, at: str | None = None) -> DataFrame:
        """Folds whose merge is the fold of all events up to the month ``until``, or up to the time ``at``.

        They are those of the last snapshot before the month ``before`` and of the single events
        since, each with its ``month``.
        """
        held = [m for m in self.snapshots() if m < before]
        start = held[-1] if held else 0
        # Exact folders: neither older months nor later ones are listed or read.
        tail = [f"{self.log}/month={m}" for m in [0, *self.months()] if not m or start < m <= until]
        events = self.spark.read.option("basePath", self.log).parquet(*tail)
        if at is not None:
            events = events.filter(F.col("timestamp") <= time_literal(events, "timestamp", at))
        folds = event_folds(events, "month")
        if not held:
            return folds
        return self.spark.read.parquet(f"{self.taken}/{start}").withColumn("month", F.lit(start)).unionByName(folds)

    def _end(self, month: int) -> int:
        year, number = divmod(month, 100)
        return 100 * year + -(-number // self.every) * self.every


def _months(names: list[str]) -> list[int]:
    """Months of partition folders that hold events."""
    return sorted(int(n.removeprefix("month=")) for n in names if n.startswith("month=") and n != "month=0")


def _month(ts: Column) -> Column:
    return (100 * F.year(ts) + F.month(ts)).cast("int")
