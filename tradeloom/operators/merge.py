"""Incremental facts: which rows to take, and the keyed merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.values import days_before
from tradeloom.session import DENSE, written
from tradeloom.sources.tables import KeyedTable

# Fixed value: the floor of an empty target.
BEGINNING = "1900-01-01"
#: Matched keys, beyond which they are not sent whole to all tasks.
MOST_SENT = 200_000


def since_target(
    source: DataFrame, column: str, target: DataFrame, target_column: str, lookback_days: int = 0
) -> DataFrame:
    """Rows not older than the newest target row minus the lookback.

    Rows with a NULL ``column`` never pass: they load with the first full run only.
    """
    newest = F.coalesce(F.max(target_column), F.lit(BEGINNING).cast("timestamp"))
    floor = target.agg(days_before(newest, lookback_days).alias("floor")).scalar()
    return source.filter(F.col(column) >= floor)


def recent_days(source: DataFrame, column: str, as_of: Column, days: int) -> DataFrame:
    return source.filter(F.col(column) >= days_before(as_of, days).cast("date"))


def _complete(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def met_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys of the batch that the target has or the batch repeats; ``_n`` rows of the batch have them."""
    sides = [df.filter(_complete(keys)).select(*keys, F.lit(n).alias("_n"), F.lit(1 - n).alias("_old")) for df, n in ((batch, 1), (target, 0))]
    counted = sides[0].unionByName(sides[1]).groupBy(*keys).agg(F.sum("_n").alias("_n"), F.max("_old").alias("_old"))
    return counted.filter((F.col("_n") > 1) | ((F.col("_n") == 1) & (F.col("_old") == 1))).drop("_old")


def single_keys(met: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of :func:`met_keys`, failing where the batch has one twice."""
    clash = F.raise_error(F.concat(F.lit(f"merge batch repeats {list(keys)}: "), F.to_json(F.struct(*keys))))
    return met.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(clash.cast("boolean"))).select(*keys)


def merge_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], append_new_columns: bool = False
) -> DataFrame:
    """Matched keys take the batch's row, other batch rows are added, the rest stays.

    New columns of the batch are appended (NULL in old rows) or, by default,
    dropped. Rows with a NULL key part match nothing and are added as they are.
    Only keys are shuffled, to find those that both sides have; these are written out,
    and unless they are many the target is read past them where it lies. The batch's rows
    are taken as they are, once its keys are known to be single.
    """
    if not append_new_columns:
        batch = batch.select(*[c for c in target.columns if c in batch.columns])
    met = written(met_keys(target, batch, keys), "met-keys", DENSE)
    single = single_keys(met, keys)
    known = single.agg(F.count("*").alias("_n")).scalar()
    matched = F.broadcast(single) if met.count() <= MOST_SENT else single
    kept = target.join(matched, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(batch.filter(known >= 0), allowMissingColumns=True)


def overlay(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the batch, and those of the target whose key it lacks."""
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def merge_into(table: KeyedTable, batch: DataFrame, append_new_columns: bool = False) -> None:
    """First run: store all rows as they are. Later: merge the touched partitions."""
    if table.read() is None:
        table.replace(batch)
        return
    table.apply(batch, lambda old, new: merge_rows(old, new, table.keys, append_new_columns))
