"""Inventory requests: ids to ask for, batches of ids, and the location grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions.documents import has_key
from tradeloom.operators.staging import elements
from tradeloom.session import written

# Fixed value: ids per request.
BATCH_SIZE = 50


def nested_ids(raw: DataFrame, array: str, id_name: str) -> DataFrame:
    """Distinct ids of the objects in ``payload[array]`` that have an id key."""
    parsed = F.from_json("payload", f"`{array}` array<string>", {"mode": "FAILFAST"})
    items = elements(raw.select(parsed.alias("doc")), f"doc.{array}")
    with_id = items.filter(has_key(F.col("item"), "id"))
    return with_id.select(F.get_json_object("item", "$.id").cast("bigint").alias(id_name)).distinct()


def id_batches(ids: DataFrame, id: str, size: int = BATCH_SIZE) -> DataFrame:
    """Ids in ascending order, ``size`` to a batch, joined by commas.

    The rank is made in two levels: range partitions get their offset from the
    partition counts, rows their rank within the partition. So no task ever
    sorts all ids. The partitioned ids are stored first, as both levels must
    see the same partition bounds.
    """
    ranged = ids.select(id).distinct().repartitionByRange(id)
    ranged = written(ranged.select(id, F.spark_partition_id().alias("_slice")), "ids")
    counts = ranged.groupBy("_slice").agg(F.count("*").alias("_n"))
    # One row per partition of the id table: small whatever the number of ids.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(id))
    ranked = ranged.withColumn("_rank", within).join(F.broadcast(offsets), "_slice")
    batch = F.floor((F.col("_offset") + F.col("_rank") - 1) / F.lit(size)).cast("bigint")
    return (
        ranked.select(batch.alias("batch"), id)
        .groupBy("batch")
        .agg(F.array_join(F.sort_array(F.collect_list(id)).cast("array<string>"), ",").alias("ids"))
    )


def location_grid(
    locations: DataFrame, variants: DataFrame, location_slices: int = 4, variant_slices: int | None = None
) -> DataFrame:
    """Every location with every variant; empty if either side is.

    The pairs are what is asked for, so all of them are made, but spread: each
    location is copied along one row of a grid of cells, each variant along one
    column, and the two are equi-joined on the cell. A task thus pairs a slice
    of the locations with a slice of the variants. Shops have far fewer
    locations than variants, so variants get many slices and few copies: as many
    slices as a shuffle has partitions, so that all tasks have cells. The join is a
    merge of sorted cells: by the size of the documents that ids are taken from, the
    optimizer would take the variants for few and send them all to the driver. The
    locations are its right side, of which a task holds a cell's rows.
    """
    variant_slices = variant_slices or max(64, int(locations.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def slice_of(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64(*df.columns), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = locations.select("*", slice_of(locations, location_slices).alias("_row"), every(variant_slices).alias("_col"))
    cols = variants.select("*", slice_of(variants, variant_slices).alias("_col"), every(location_slices).alias("_row"))
    pairs = cols.hint("merge").join(rows, ["_row", "_col"])
    return pairs.select(*locations.columns, *variants.columns)
