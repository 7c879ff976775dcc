"""Checks before a run, cheapest first; the first that fails raises."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PreflightError(RuntimeError):
    pass


def run(chunks: DataFrame, existing: DataFrame | None = None, dimensions: int | None = None, vectors: DataFrame | None = None) -> dict:
    out = {"columns": sorted(chunks.columns), "existing_nodes": existing.count() if existing is not None else 0}
    for needed in ("id", "text"):
        if needed not in chunks.columns:
            raise PreflightError(f"chunks have no column {needed}")
    if vectors is not None and dimensions:
        wrong = vectors.where(F.size("embedding") != dimensions).limit(1).count()
        if wrong:
            raise PreflightError(f"an embedding does not have {dimensions} numbers")
    out["warnings"] = ["the graph is not empty"] if out["existing_nodes"] else []
    return out


def unique(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that break a uniqueness constraint."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def present(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())
