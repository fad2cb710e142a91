"""Saved API pages: JSON envelopes holding a list of items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.sources.domains import Domain

PAGE_NUMBER_IN_NAME = r"(\d+)[^/\d]*$"
# A malformed page is an error.
_OPTIONS = {"mode": "FAILFAST"}


def read_pages(spark: SparkSession, path: str, domain: Domain, whole_files: bool = False) -> DataFrame:
    """Page number, items as text and file of every page, one page per line or (``whole_files``) per file.

    One per line packs many pages into a file, which suits large archives;
    one per file allows pretty-printed documents. The reader, unlike
    ``from_json``, hands on the text of an item byte for byte.
    """
    reader = spark.read.schema(_schema(domain)).options(**_OPTIONS, multiLine=whole_files)
    return _with_file(reader.json(path))


def stream_pages(
    spark: SparkSession, path: str, domain: Domain, whole_files: bool = False, files_per_batch: int = 1000
) -> DataFrame:
    """The same as a file stream."""
    reader = spark.readStream.schema(_schema(domain)).options(**_OPTIONS, multiLine=whole_files)
    return _with_file(reader.option("maxFilesPerTrigger", files_per_batch).json(path))


def _schema(domain: Domain) -> str:
    return f"`page` bigint, `{domain.envelope}` array<string>"


def _with_file(pages: DataFrame) -> DataFrame:
    file = F.col("_metadata")
    return pages.select("*", file["file_name"].alias("file"), file["file_modification_time"].alias("file_time"))


def explode_items(pages: DataFrame, domain: Domain) -> DataFrame:
    """One row per item with its arrival order ``(file_time, page, position)``.

    A page without the envelope key has no items. The page number is the
    envelope's ``page`` if present, else the digits that end the file name. A
    later crawl's first page comes after an earlier crawl's last one.
    """
    number: Column = F.coalesce(
        F.col("page"),
        F.expr("try_cast(regexp_extract(file, r'%s', 1) AS bigint)" % PAGE_NUMBER_IN_NAME),
        F.lit(0),
    )
    return pages.select(
        "file_time",
        number.cast("bigint").alias("page"),
        # Outer, then filtered: see ``operators.staging.elements``.
        F.posexplode_outer(domain.envelope).alias("position", "item"),
    ).filter("item IS NOT NULL")


def ingest(spark: SparkSession, path: str, domain: Domain, whole_files: bool = False) -> DataFrame:
    return explode_items(read_pages(spark, path, domain, whole_files), domain)
