"""Type 2 history from a log of snapshots, and lookups into it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..schemas import END, START
from .hotkeys import HOT_ROWS, SLICE, hot_keys, in_slices, join_on, split_hot


def scd2(
    log: DataFrame,
    keys: Sequence[str],
    sequence: str,
    *,
    untracked: Sequence[str] = (),
    tie_break: Sequence[str] = (),
    start: str = START,
    end: str = END,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row per key and run of equal tracked values, in sequence order.

    Every column but the keys, ``sequence``, ``untracked`` and ``tie_break`` is
    tracked: a NULL-safe difference to the row before opens a version, which
    closes the former at the new start. ``sequence`` and the untracked columns
    carry the last value seen in the version. Of rows that share key and
    sequence the last by ``tie_break``, then by hash of the content, counts.
    Rows without a sequence have no place in a history and are left out.
    ``end`` is NULL for the open version.

    All keys go through one shuffle and one sort. Keys with more than
    ``hot_rows`` rows are cut into slices; ``None`` skips the look for them
    where the caller knows a bound. ``counted`` names a stored table with the
    key columns of at least the rows of ``log``; keys are counted there, so that
    the look does not compute the log a second time.
    """
    plan = _History(log, keys, sequence, untracked, tie_break, start, end)
    rows = log.where(F.col(sequence).isNotNull())
    hot = hot_keys(rows if counted is None else counted, keys, hot_rows) if hot_rows is not None else None
    if hot is None:
        return plan.versions(rows)
    crowded, rest = split_hot(rows, hot, keys)
    return plan.versions(rest).unionByName(plan.versions_in_slices(crowded, hot_rows))


class _History:
    """Column roles of one history and the two plans that build it."""

    def __init__(self, log, keys, sequence, untracked, tie_break, start, end):
        taken = {*keys, sequence, *untracked, *tie_break}
        self.keys, self.sequence, self.tie_break = list(keys), sequence, list(tie_break)
        self.tracked = [c for c in log.columns if c not in taken]
        self.carried = [sequence, *untracked]
        self.start, self.end = start, end
        self.columns = [c for c in log.columns if c not in set(tie_break)]
        self.state = F.struct(*self.tracked) if self.tracked else F.lit(True)
        self.last_seen = F.struct(*self.carried)

    def _precedence(self) -> list[Column]:
        content = [c for c in self.columns if c not in {*self.keys, self.sequence}]
        return [*map(F.col, self.tie_break), F.xxhash64(*content) if content else F.lit(0)]

    def versions(self, rows: DataFrame) -> DataFrame:
        """Windows over whole keys: one shuffle, one sort."""
        seq = F.col(self.sequence)
        by_key = Window.partitionBy(*self.keys)
        among_ties = by_key.orderBy(seq, *self._precedence())
        in_order = by_key.orderBy(seq)

        following = F.lead(seq).over(among_ties)
        one_per_moment = (
            rows.withColumn("_following", following)
            .where(F.col("_following").isNull() | (F.col("_following") != seq))
            .select(*self.columns)
        )
        marked = self._mark(one_per_moment, in_order)
        # Only the first and last row of each run are left, so the row after a
        # run's first is its last (or, for runs of one row, the next run).
        ahead = marked.select(
            "*",
            F.lead(seq, 1).over(in_order).alias("_seq1"),
            F.lead(seq, 2).over(in_order).alias("_seq2"),
            F.lead(self.last_seen, 1).over(in_order).alias("_seen1"),
        )
        return self._published(
            ahead.where("_opens"),
            seen=F.when(F.col("_closes"), self.last_seen).otherwise(F.col("_seen1")),
            until=F.when(F.col("_closes"), F.col("_seq1")).otherwise(F.col("_seq2")),
        )

    def _neighbours(self, window) -> list[Column]:
        return [
            F.lag(self.state).over(window).alias("_state_before"),
            F.lag(self.sequence).over(window).alias("_seq_before"),
            F.lead(self.state).over(window).alias("_state_after"),
            F.lead(self.sequence).over(window).alias("_seq_after"),
        ]

    def _flagged(self, rows: DataFrame) -> DataFrame:
        """Keep the rows that open or close a run of equal tracked values."""
        differs = lambda side: ~self.state.eqNullSafe(F.col(f"_state_{side}"))
        opens = F.col("_seq_before").isNull() | differs("before")
        closes = F.col("_seq_after").isNull() | differs("after")
        return rows.select(*self.columns, *(c for c in rows.columns if c == SLICE),
                           opens.alias("_opens"), closes.alias("_closes")).where("_opens OR _closes")

    def _mark(self, rows: DataFrame, window) -> DataFrame:
        return self._flagged(rows.select("*", *self._neighbours(window)))

    def _published(self, openings: DataFrame, seen: Column, until: Column) -> DataFrame:
        seen_now = openings.select("*", seen.alias("_seen"), until.alias("_until"))
        shown = [F.col(f"_seen.{c}").alias(c) if c in self.carried else F.col(c) for c in self.columns]
        return seen_now.select(
            *shown, F.col(self.sequence).alias(self.start), F.col("_until").alias(self.end)
        )

    def versions_in_slices(self, rows: DataFrame, hot_rows: int) -> DataFrame:
        """The same history for keys too large for one task.

        Rows of one key and moment are merged by a partial aggregate first, so
        that (key, sequence) is unique and slices can be cut anywhere.
        """
        rest = [c for c in self.columns if c not in {*self.keys, self.sequence}]
        winner = F.max_by(F.struct(F.lit(0).alias("_"), *rest), F.struct(*self._precedence()))
        unique = cut_lineage(
            rows.groupBy(*self.keys, self.sequence)
            .agg(winner.alias("_row"))
            .select(*self.keys, self.sequence, *(F.col(f"_row.{c}").alias(c) for c in rest))
        )
        sliced = in_slices(unique, self.keys, [self.sequence], hot_rows)
        cell = [*self.keys, SLICE]
        in_slice = Window.partitionBy(*cell).orderBy(self.sequence)
        across = Window.partitionBy(*self.keys).orderBy(SLICE)

        halo = sliced.groupBy(*cell).agg(
            F.min(self.sequence).alias("_first"), F.min_by(self.state, self.sequence).alias("_head"),
            F.max(self.sequence).alias("_last"), F.max_by(self.state, self.sequence).alias("_tail"),
        ).select(
            *cell,
            F.lag("_tail").over(across).alias("_halo_state_before"),
            F.lag("_last").over(across).alias("_halo_seq_before"),
            F.lead("_head").over(across).alias("_halo_state_after"),
            F.lead("_first").over(across).alias("_halo_seq_after"),
        )
        inner = sliced.select("*", *self._neighbours(in_slice))
        joined = join_on(inner, halo, cell, "left").withColumns({
            f"_{what}_{side}": F.when(
                F.col(f"_seq_{side}").isNull(), F.col(f"_halo_{what}_{side}")
            ).otherwise(F.col(f"_{what}_{side}"))
            for side in ("before", "after") for what in ("state", "seq")
        })
        flagged = cut_lineage(self._flagged(joined))

        # First opening and first closing of the slices after this one.
        backwards = Window.partitionBy(*self.keys).orderBy(F.desc(SLICE)).rowsBetween(
            Window.unboundedPreceding, -1
        )
        later = flagged.groupBy(*cell).agg(
            F.min(F.when(F.col("_opens"), F.col(self.sequence))).alias("_open"),
            F.min_by(self.last_seen, F.when(F.col("_closes"), F.col(self.sequence))).alias("_close"),
        ).select(
            *cell,
            F.last("_open", ignorenulls=True).over(backwards).alias("_later_open"),
            F.last("_close", ignorenulls=True).over(backwards).alias("_later_close"),
        )
        seq = F.col(self.sequence)
        ahead = flagged.select(
            "*",
            F.lead(seq, 1).over(in_slice).alias("_seq1"),
            F.lead(seq, 2).over(in_slice).alias("_seq2"),
            F.lead(self.last_seen, 1).over(in_slice).alias("_seen1"),
        ).where("_opens")
        return self._published(
            join_on(ahead, later, cell, "left"),
            seen=F.when(F.col("_closes"), self.last_seen).otherwise(
                F.coalesce("_seen1", "_later_close")),
            until=F.coalesce(
                F.when(F.col("_closes"), F.col("_seq1")).otherwise(F.col("_seq2")), "_later_open"),
        )


def current(history: DataFrame, end: str = END) -> DataFrame:
    """Open versions only."""
    return history.where(F.col(end).isNull())


def valid_at(history: DataFrame, moment: Column, start: str = START, end: str = END) -> DataFrame:
    """Versions valid at a moment; a version ends just before its end."""
    return history.where((F.col(start) <= moment) & (F.col(end).isNull() | (moment < F.col(end))))


def history_of(history: DataFrame, key: str, value: object, start: str = START) -> DataFrame:
    """All versions of one key, oldest first."""
    return history.where(F.col(key) == F.lit(value)).orderBy(start)


def with_timestamps(history: DataFrame, start: str = START, end: str = END) -> DataFrame:
    """Validity columns as timestamps, whatever the type of the sequence."""
    return history.withColumns({c: F.col(c).cast("timestamp") for c in (start, end)})
