"""What has been loaded and indexed, as (filename, sha256) tables, and what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_file(manifest: DataFrame) -> DataFrame:
    """sha256, filename: the greatest file name that holds each checksum."""
    return manifest.filter("sha256 is not null").groupBy("sha256").agg(F.max("filename").alias("filename"))


def not_loaded(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    """Files whose checksum no output holds; those without a checksum are among them."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")


def loaded(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    return files.join(manifest.select(key).distinct(), key, "left_semi")


def files_to_update(loaded_manifest: DataFrame, indexed: DataFrame) -> DataFrame:
    """filename of every output that holds a checksum not indexed yet."""
    return loaded_manifest.filter("sha256 is not null").join(indexed.select("sha256").distinct(), "sha256", "left_anti").select("filename").distinct()


def current_files(manifest: DataFrame) -> DataFrame:
    """filename of every output that is the latest for one of its checksums at least; the others are superseded."""
    return latest_file(manifest).select("filename").distinct()


def superseded_files(manifest: DataFrame) -> DataFrame:
    return manifest.select("filename").distinct().join(current_files(manifest), "filename", "left_anti")
