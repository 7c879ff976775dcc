"""Providers of what needs a model: embedding, summary, extraction; with offline defaults.

A live provider subclasses nothing: it is a function of columns or rows.  Retries belong
inside it, as a Spark task retry would repeat the whole partition.
"""

from __future__ import annotations

import os
import random
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import wraps

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import retrieval


class EngineError(Exception):
    """Base of the engine's own errors."""


class ProviderError(EngineError):
    """A provider's call failed; `original` is the error below."""

    def __init__(self, message: str, original: Exception | None = None) -> None:
        super().__init__(message)
        self.original = original


class ConfigError(EngineError):
    pass


def retried(*errors: type[Exception], attempts: int = 3, longest: float = 60.0, sleep: Callable[[float], None] = time.sleep):
    """Call again on the given errors, or on a ProviderError around one, after a random wait
    that doubles at most to `longest` seconds."""
    def wrap(call):
        @wraps(call)
        def run(*args, **options):
            for attempt in range(1, attempts + 1):
                try:
                    return call(*args, **options)
                except Exception as error:  # noqa: BLE001  rethrown unless it is one to retry
                    if attempt == attempts or not isinstance(getattr(error, "original", None) or error, errors):
                        raise
                    sleep(random.uniform(0, min(longest, 2.0**attempt)))
            return None

        return run

    return wrap


@dataclass(frozen=True)
class Config:
    """Settings of a run; secrets are left out of `public`."""

    tables: str = "."
    output: str = "out"
    dimensions: int = 64
    gleanings: int = 2
    api_key: str = field(default="", repr=False)

    @classmethod
    def from_env(cls, live: bool = False) -> Config:
        made = cls(os.environ.get("KGLOOM_TABLES", "."), os.environ.get("KGLOOM_OUTPUT", "out"), int(os.environ.get("KGLOOM_DIMENSIONS", "64")), int(os.environ.get("KGLOOM_GLEANINGS", "2")), os.environ.get("KGLOOM_API_KEY", ""))
        if live and not made.api_key:
            raise ConfigError("a live provider needs KGLOOM_API_KEY")
        return made

    def public(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k != "api_key"}


def _counted(dimensions: int):
    @F.pandas_udf("array<float>")
    def run(places: pd.Series) -> pd.Series:
        return places.map(lambda p: None if p is None else np.bincount(p, minlength=dimensions).astype(np.float32))

    return run


def hashed_vector(text: Column, dimensions: int = 64) -> Column:
    """A deterministic embedding: counts of words hashed to places; null text gives null.
    Words and hashes stay in the JVM; Arrow batches carry the places to one bincount."""
    places = F.transform(retrieval.tokens(text), lambda t: F.pmod(F.xxhash64(t), F.lit(dimensions)).cast("int"))
    return _counted(dimensions)(places)


def embed(rows: DataFrame, column: str, dimensions: int = 64) -> DataFrame:
    return rows.withColumn("embedding", F.when(F.col(column).isNotNull(), hashed_vector(F.col(column), dimensions)))


def community_search(summaries: DataFrame, question: str, k: int = 3, dimensions: int = 64) -> DataFrame:
    """The communities whose summary is nearest to a question."""
    rows = embed(summaries.select(F.col("community").alias("id"), "summary"), "summary", dimensions).where("embedding is not null")
    one = rows.sparkSession.createDataFrame([(question,)], "text string").select(hashed_vector(F.col("text"), dimensions).alias("q"))
    return retrieval.vector_topk(rows, one, k)
