"""A vector index that stays: lists of like vectors as partitions, probed and then scored exactly.

A coarse quantiser, k-means on at most SAMPLE vectors, gives the centres of the lists; every vector of the table is filed in the
list of its nearest centre, in a table with a folder for a list, next to the angle from its centre. A search files each query
under its nearest lists, reads those, and scores what it finds with the full vectors. Two ways:

* `probes` lists: approximate. A test measures its recall against the exhaustive search.
* exact: the probed lists give each query a `top`-th score; a list can only hold better vectors if the angle between the query
  and its centre, less the list's radius, is small enough, as angles between unit vectors keep the triangle inequality. Lists
  that can are read as well. For queries that have found less than `top` all lists are.

Vectors are unit vectors, as for dense_search, of one length. Null vectors are in no list and never found. The centres, a small
matrix, are the only thing that the driver and every task hold.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import materialise, release
from . import blocks
from .retrieval import ranked

#: Vectors that the quantiser is fitted on, and lists for each of a million vectors.
SAMPLE = 50_000
PROBES = 8
#: Float vectors are unit vectors to some 1e-7; angles of near vectors turn that into some 1e-3.
SLACK = 2e-3


def centres(vectors: DataFrame, lists: int, sample: int = SAMPLE, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Unit centres of at most `lists` lists, from a sample of at most about `sample` vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    known = vectors.where("embedding IS NOT NULL").select("embedding")
    n = known.count()
    some = known.sample(min(1.0, sample / n), seed) if n > sample else known
    rows, path = materialise(some.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features")), "vector-sample")
    found = np.array(KMeans(k=max(1, lists), maxIter=rounds, initSteps=2, seed=seed).fit(rows).clusterCenters()) if n else np.zeros((1, 1))
    release(vectors.sparkSession, path)
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.where(norm > 0, norm, 1)


def nearest(embedding: str, at: np.ndarray, n: int) -> Column:
    """The n nearest centres of a vector, as (list, angle), nearest first."""
    matrix = at.T.astype(np.float64)

    @F.pandas_udf("array<struct<list:int,angle:double>>")
    def find(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        angle = np.arccos(np.clip(np.stack(x.to_numpy()).astype(np.float64) @ matrix, -1, 1))
        order = angle.argmin(axis=1)[:, None] if n == 1 else np.argsort(angle, axis=1, kind="stable")[:, :n]
        return pd.Series([[{"list": int(k), "angle": float(row[k])} for k in some] for row, some in zip(angle, order, strict=True)])

    return find(embedding)


def build(vectors: DataFrame, path: str, lists: int | None = None, key: str = "vec_id", sample: int = SAMPLE) -> None:
    """Files every vector. Without `lists` there are about as many as a list has vectors."""
    spark = vectors.sparkSession
    lists = lists or max(1, round(vectors.count() ** 0.5))
    at = centres(vectors, lists, sample)
    spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(at)], "list int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
    add(vectors, path, key, at, "overwrite")


def load(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/centres").orderBy("list").collect()
    return np.array([r.centre for r in rows])


def add(vectors: DataFrame, path: str, key: str = "vec_id", at: np.ndarray | None = None, mode: str = "append") -> None:
    """Files further vectors under the centres of the index."""
    at = load(vectors.sparkSession, path) if at is None else at
    filed = vectors.where("embedding IS NOT NULL").select(key, "embedding", nearest("embedding", at, 1)[0].alias("_l")).select(key, "embedding", F.col("_l.list").alias("list"), F.col("_l.angle").alias("angle"))
    # a list with very many vectors is split over several tasks and files
    filed.hint("rebalance", "list").write.mode(mode).option("compression", "zstd").partitionBy("list").parquet(f"{path}/lists")


def search(spark: SparkSession, path: str, queries: DataFrame, key: str = "vec_id", query: str = "query_id", top: int = 15, probes: int = PROBES, exact: bool = False) -> DataFrame:
    """(query, key, rank, score): the best `top` vectors of each query's lists, or of all if `exact`.

    Lists and queries meet in blocks (see blocks). The driver gets the numbers of the lists that are read, at most one for each
    centre that it holds.
    """
    at = load(spark, path)
    vectors = spark.read.parquet(f"{path}/lists")
    asked, p_asked = materialise(queries.where("embedding IS NOT NULL").select(query, "embedding", F.transform(nearest("embedding", at, probes), lambda c: c["list"]).alias("_lists")), "vector-queries")
    doubles = tuple("array<double>" in dict(d.dtypes)["embedding"] for d in (vectors, asked))
    order = [F.desc("score"), F.col(key)]

    def filed(lists: DataFrame) -> DataFrame:
        wanted = sorted(r[0] for r in lists.select("list").distinct().collect())
        some = vectors if len(wanted) == len(at) else vectors.where(F.col("list").isin(wanted))
        return blocks.packed(some.select("list", key, "embedding"), key, "list", top)

    probed = asked.select(query, "embedding", F.explode("_lists").alias("list"))
    own = blocks.packed(probed.repartition("list").sortWithinPartitions("list"), query, "list").withColumnRenamed("embedding", "_q")
    near, p_near = materialise(ranked(blocks.nearest(filed(probed).join(own, "list"), key, query, top, doubles), query, order, top).select(query, key, "score", "rank"), "vector-near")
    if not exact:
        release(spark, p_asked)
        return near
    floor = near.groupBy(query).agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == top).drop("n")
    parts = max(1, -(-asked.count() // blocks.BLOCK))
    every, p_every = materialise(blocks.packed(asked.drop("_lists").join(floor, query, "left").repartition(parts), query).withColumnRenamed("embedding", "_q"), "vector-asked")
    balls, p_balls = materialise(vectors.groupBy("list").agg(F.max("angle").alias("radius")).join(spark.read.parquet(f"{path}/centres"), "list"), "vector-lists")
    # the lists are dealt to all tasks, and the queries' blocks go to each
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_ = filed(blocks.reached(balls.crossJoin(every.select("_q", "floor")), "list", doubles[1], SLACK)).repartition(tasks).join(F.broadcast(balls), "list")
    out, _ = materialise(ranked(blocks.nearest(open_.crossJoin(every), key, query, top, doubles, SLACK), query, order, top).select(query, key, "score", "rank"), "vector-hits")
    release(spark, p_asked, p_near, p_every, p_balls)
    return out
