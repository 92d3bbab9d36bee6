"""Interfaces to models and services, each with a deterministic stand-in that needs neither.

A provider turns a DataFrame into one with a further column, so that everything downstream only sees columns. Results that
were made elsewhere come in as a join table.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.text import tokens
from .operators.retrieval import cosine


class Provider(Protocol):
    def __call__(self, rows: DataFrame) -> DataFrame: ...


def joined(results: DataFrame, keys: list[str]) -> Provider:
    """Results of an earlier run, by key."""
    return lambda rows: rows.join(results, keys, "left")


def hashed_vectors(text: str = "text", size: int = 64, out: str = "embedding") -> Provider:
    """Unit vectors of hashed term counts, in place of an embedding model."""

    @F.pandas_udf("array<float>")
    def unit(x: pd.Series) -> pd.Series:
        def of(bins: np.ndarray | None) -> np.ndarray:
            counts = np.bincount([] if bins is None else bins, minlength=size).astype(float)
            return (counts / (np.sqrt(counts @ counts) or 1.0)).astype(np.float32)

        return x.map(of, na_action=None)

    def run(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, unit(F.transform(tokens(text), lambda t: F.pmod(F.xxhash64(t), F.lit(size)))))

    return run


def same_query(text: str = "text", out: str = "query") -> Provider:
    """The statement itself, in place of a rewritten query."""
    return lambda rows: rows.withColumn(out, F.col(text))


def similarity_grade(a: str, b: str, out: str = "grade") -> Provider:
    """Ten times the cosine of two vectors, in place of a model's grade from 0 to 10."""
    return lambda rows: rows.withColumn(out, F.round(F.greatest(F.lit(0.0), cosine(a, b)) * 10, 4))


def support(atom: str = "text", context: str = "context", out: str = "p_true") -> Provider:
    """Share of an atom's terms that its context has, shrunk towards 0.5, in place of inference and belief propagation."""

    def run(rows: DataFrame) -> DataFrame:
        a, c = F.array_distinct(tokens(atom)), F.array_distinct(tokens(context))
        n = F.size(a)
        return rows.withColumn(out, F.when((n > 0) & F.col(context).isNotNull(), (F.size(F.array_intersect(a, c)) + 1.0) / (n + 2.0)).otherwise(F.lit(0.5)))

    return run


#: Risks that go to every task at once.
BROADCAST_RISKS = 10_000


def risks(card: DataFrame, table: DataFrame, limit: int = 5, text: str = "text") -> DataFrame:
    """(card_id, risks): of a risk table (id, name, description, url, words) those with a word in the card, at most `limit`."""
    from pyspark.sql import Window

    hits = None
    # every card meets every risk; the risks go to the cards in blocks of bounded size
    blocks = max(1, -(-table.count() // BROADCAST_RISKS))
    for b in range(blocks):
        some = table.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else table
        found = card.join(F.broadcast(some), F.exists("words", lambda w: F.lower(F.col(text)).contains(w))).select("card_id", "id", "name", "description", "url").distinct()
        hits = found if hits is None else hits.unionByName(found)
    first = hits.withColumn("_r", F.row_number().over(Window.partitionBy("card_id").orderBy("id"))).where(F.col("_r") <= limit)
    return first.groupBy("card_id").agg(F.array_sort(F.collect_list(F.struct("id", F.col("name").alias("category"), "description", "url"))).alias("risks"))


REGISTRY: dict[str, Callable[..., Provider]] = {"embed": hashed_vectors, "rewrite": same_query, "grade": similarity_grade, "support": support}


def register(name: str, make: Callable[..., Provider]) -> None:
    """Replaces a stand-in by a real provider."""
    REGISTRY[name] = make
