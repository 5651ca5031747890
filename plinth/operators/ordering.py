"""Order-dependent primitives that never put a whole group into one task.

A plain ``row_number() over (partition by kind order by seq)`` sends every row of a hot kind to one task. Here the order
itself is first cut into ranges of about equal size, windows run inside ``(key, range)``, and one summary row per
``(key, range)`` carries the running state from range to range. The summary window sees at most ``buckets`` rows per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.runtime import cut

BUCKET = "_range"


@dataclass(frozen=True)
class Step:
    """One running value: windows over the rows of a range, a summary per range, what earlier ranges add, the result.

    ``local`` and ``carry`` are stages of named columns, each of which may use those before it.
    """

    out: str
    local: list[dict[str, Column]]
    totals: dict[str, Column]
    carry: list[dict[str, Column]]
    value: Column


class Ordered:
    """Rows of ``df`` in ascending ``order`` within each ``by`` key, null order keys first.

    Descending orders are expressed by negating the column. ``order`` should end in a unique column, so that ties cannot
    pile up in one range and ranks are reproducible. Ranges are those of Spark's own range partitioning, numbered by
    partition, so the plan has one size for any number of them. All values asked for in a row are found in one pass: rows
    are numbered and windowed once, written as a table, and joined with one summary row per key and range.
    """

    def __init__(self, df: DataFrame, order: Sequence[str], by: Sequence[str] = (), buckets: int | None = None, ranged: bool = False):
        self.order, self.by = list(order), list(by)
        self._rows, self._steps, self._ranged = df, [], ranged
        self.buckets = buckets or max(16, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))

    @property
    def keys(self) -> list[str]:
        return [*self.by, BUCKET]

    def _here(self):
        """Window over the rows of one key and range."""
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def _ranges(self):
        """Window over the summary rows of one key: at most ``buckets`` of them."""
        return (Window.partitionBy(*self.by) if self.by else Window.partitionBy(F.lit(0))).orderBy(BUCKET)

    def _folded(self, out: str, column: Column, fold, frame_end: int = 0) -> "Ordered":
        """A running fold that is its own way to combine ranges (sum, maximum)."""
        upto = self._here().rowsBetween(Window.unboundedPreceding, frame_end)
        earlier = self._ranges().rowsBetween(Window.unboundedPreceding, -1)
        self._steps.append(Step(out, [{f"_l_{out}": fold(column).over(upto)}], {f"_t_{out}": fold(column)},
                                [{f"_c_{out}": fold(f"_t_{out}").over(earlier)}], F.lit(None)))
        return self

    def _last(self, value: Column) -> "Ordered":
        self._steps[-1] = replace(self._steps[-1], value=value)
        return self

    def row_number(self, out: str) -> "Ordered":
        """1-based position within the key."""
        return self._folded(out, F.lit(1), F.sum)._last((F.coalesce(F.col(f"_c_{out}"), F.lit(0)) + F.col(f"_l_{out}")).cast("long"))

    def running_sum(self, column: str, out: str) -> "Ordered":
        """Inclusive running total of ``column`` within the key."""
        return self._folded(out, F.col(column), F.sum)._last(F.coalesce(F.col(f"_c_{out}"), F.lit(0)) + F.col(f"_l_{out}"))

    def running_max(self, column: str, out: str) -> "Ordered":
        """Inclusive running maximum of ``column`` within the key."""
        return self._folded(out, F.col(column), F.max)._last(F.greatest(F.col(f"_c_{out}"), F.col(f"_l_{out}")))

    def last_before(self, column: str, out: str, inclusive: bool = False) -> "Ordered":
        """Newest non-null ``column`` of an earlier row (or of this row too, when inclusive)."""
        upto = self._here().rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        earlier = self._ranges().rowsBetween(Window.unboundedPreceding, -1)
        newest = F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*self.order)))
        self._steps.append(Step(
            out, [{f"_l_{out}": F.last(column, ignorenulls=True).over(upto)}], {f"_t_{out}": newest},
            [{f"_c_{out}": F.last(f"_t_{out}", ignorenulls=True).over(earlier)}], F.coalesce(F.col(f"_l_{out}"), F.col(f"_c_{out}"))))
        return self

    def stretches(self, column: str, out: str) -> "Ordered":
        """Number, from 1, of the stretch of unchanged ``column`` a row lies in; null is a value like others.

        A range counts the changes inside it; whether its first row changes too is settled between the summaries.
        """
        upto = self._here().rowsBetween(Window.unboundedPreceding, 0)
        earlier = self._ranges().rowsBetween(Window.unboundedPreceding, -1)
        value, before = F.struct(F.col(column).alias("v")), F.col(f"_b_{out}")
        changed = F.when(before.isNull() | before.eqNullSafe(value), 0).otherwise(1)
        ends = F.lag(f"_z_{out}").over(self._ranges())
        edge = F.when(F.col(f"_p_{out}").eqNullSafe(F.col(f"_a_{out}")), 0).otherwise(1)
        self._steps.append(Step(
            out, [{f"_b_{out}": F.lag(value).over(self._here())}, {f"_l_{out}": F.sum(changed).over(upto)}],
            {f"_t_{out}": F.max(f"_l_{out}"), f"_a_{out}": F.min_by(value, F.struct(*self.order)), f"_z_{out}": F.max_by(value, F.struct(*self.order))},
            [{f"_p_{out}": ends}, {f"_e_{out}": edge}, {f"_c_{out}": F.coalesce(F.sum(F.col(f"_t_{out}") + F.col(f"_e_{out}")).over(earlier), F.lit(0)) + F.col(f"_e_{out}")}],
            (F.col(f"_l_{out}") + F.col(f"_c_{out}")).cast("long")))
        return self

    def done(self) -> DataFrame:
        """The rows with all values asked for."""
        columns = self._rows.columns
        rows = self._rows if self._ranged else self._rows.repartitionByRange(self.buckets, *self.order).withColumn(BUCKET, F.spark_partition_id())
        columns = [c for c in columns if c != BUCKET]
        for stage in range(max(len(s.local) for s in self._steps)):
            rows = rows.withColumns({n: c for s in self._steps if stage < len(s.local) for n, c in s.local[stage].items()})
        rows = cut(rows)
        summary = rows.groupBy(*self.keys).agg(*[c.alias(n) for s in self._steps for n, c in s.totals.items()])
        for stage in range(max(len(s.carry) for s in self._steps)):
            summary = summary.withColumns({n: c for s in self._steps if stage < len(s.carry) for n, c in s.carry[stage].items()})
        carried = summary.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], *[f"_c_{s.out}" for s in self._steps])
        same = all_of([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
        return rows.join(carried, same).select(*columns, *[s.value.alias(s.out) for s in self._steps])


def ranked(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), out: str = "rn",
           buckets: int | None = None) -> DataFrame:
    """Distributed ``row_number() over (partition by by order by order)``."""
    return Ordered(df, order, by, buckets).row_number(out).done()


def hash_ranked(df: DataFrame, digest: str, tie: str, by: Sequence[str] = (), out: str = "rn",
                hex_digits: int | None = None) -> DataFrame:
    """``ranked`` for a hex digest column: its leading digits are already equal-sized ranges.

    Their number follows the shuffle partitions unless given.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    hex_digits = hex_digits or max(2, -(-(parts - 1).bit_length() // 4))
    spread = df.withColumn(BUCKET, F.substring(F.col(digest), 1, hex_digits))
    return Ordered(spread, [digest, tie], by, ranged=True).row_number(out).done()


def all_of(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)
