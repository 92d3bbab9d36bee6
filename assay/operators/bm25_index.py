"""A BM25 index that stays: inverted tables in a folder, kept up batch by batch, searched without reading the corpus.

Tables below the index's folder, each with a folder for a batch and in it one for a bucket of terms:

* postings (term, key, tf, dl, block), files sorted by term; term '' has one row for each document.
* dictionary (term, df), of one batch.
* blocks (term, block, max_tf, min_dl): the best that a term can do in a block, whatever average length and idf become later.
  A block holds documents of one batch and of like length.
* versions (batch, n_docs, n_dl, total): the batches that count, with their sizes. It is written last, as one file for a version,
  so a search sees a batch whole or not at all, and a batch that failed half-way is overwritten by the next.

A search reads the buckets of its queries' terms only. It adds up, for each query and block, the most that a document there can
score, scores the FIRST best blocks of each query, and then all blocks that can still beat the `top`-th score found: an exact
search that leaves out blocks, as in block-max pruning. Scores fall with length and rise with frequency, and a term with a
negative idf adds nothing to a bound, so no bound is too low.

One writer at a time. Documents whose key is in the index already are left out, so adding a batch twice adds it once. Null texts
count as documents without a length. `compact` makes one batch of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions.text import tokens
from ..storage import materialise, release
from .retrieval import K1, B, query_terms, ranked

BUCKETS = 32
#: Parts of the documents of one batch and class of length.
PARTS = 16
#: Blocks of each query that are scored first.
FIRST = 4
#: Documents that are counted at once; terms of queries, and blocks of queries, up to which they are broadcast.
COUNTED, FEW = 512, 500_000
SLACK = 1e-6


def bucket(term: str = "term") -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def gain(tf: str, dl: str, avgdl: float) -> Column:
    """What a term adds for each unit of its weight. Rises with tf, falls with dl."""
    return F.col(tf) * (K1 + 1) / (F.col(tf) + K1 * (1 - B + B * F.col(dl) / F.lit(avgdl)))


def versions(spark: SparkSession, path: str) -> tuple[int, list]:
    """The last version and its rows (batch, n_docs, n_dl, total); 0 and none for a new index."""
    try:
        rows = spark.read.parquet(f"{path}/versions")
    except AnalysisException:
        return 0, []
    last = rows.agg(F.max("version")).first()[0]
    return last, rows.where(F.col("version") == last).collect()


def _commit(spark: SparkSession, path: str, version: int, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, "batch int, n_docs long, n_dl long, total long").coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/version={version}")


def _write(rows: DataFrame, path: str, table: str, batch: int, deal: bool = True) -> None:
    rows = rows.withColumn("bucket", bucket())
    # rebalance: small buckets go together, a bucket with a frequent term is split over several tasks and files
    rows = rows.hint("rebalance", "bucket") if deal else rows
    rows.sortWithinPartitions("bucket", "term").write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/{table}/batch={batch}")


def counted(words: DataFrame) -> DataFrame:
    """Every other column with (term, tf) of each document's words `_w`, counted within Arrow batches, so nothing is shuffled."""
    kinds = dict(words.dtypes)
    others = [c for c in words.columns if c != "_w"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED):
                part = batch.slice(at, COUNTED)
                terms = part.column("_w").flatten().dictionary_encode()
                rows = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column("_w")).to_numpy(zero_copy_only=False))
                n = max(1, len(terms.dictionary))
                both, tf = np.unique(rows * n + terms.indices.to_numpy(), return_counts=True)
                of = pa.array(both // n)
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(of) for c in others], terms.dictionary.take(pa.array(both % n)), pa.array(tf, pa.int64())], names=[*others, "term", "tf"])

    return words.mapInArrow(run, ", ".join([*[f"`{c}` {kinds[c]}" for c in others], "term string, tf bigint"]))


def read(spark: SparkSession, path: str, table: str, batches: list[int], buckets: list[int] | None = None) -> DataFrame:
    """A table's rows of the batches that count, and of some buckets; other folders are not read."""
    rows = spark.read.parquet(f"{path}/{table}").where(F.col("batch").isin(batches))
    return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))


def _summaries(spark: SparkSession, path: str, batch: int) -> tuple[int, int, int]:
    """Writes dictionary and blocks of a batch from its postings; its (n_docs, n_dl, total)."""
    made = spark.read.parquet(f"{path}/postings/batch={batch}")
    words = made.where("term <> ''")
    # the groups are dealt by their keys already, in as many tasks as their size asks for
    _write(words.groupBy("term").agg(F.count("*").alias("df")), path, "dictionary", batch, deal=False)
    _write(words.groupBy("term", "block").agg(F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")), path, "blocks", batch, deal=False)
    n, n_dl, total = made.where("term = ''").agg(F.count("*"), F.count("dl"), F.sum("dl")).first()
    return n, n_dl, total or 0


def add(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> int:
    """Adds the documents that are not in the index yet, as one batch; the version that holds them."""
    spark = docs.sparkSession
    version, live = versions(spark, path)
    batch = max([r.batch for r in live], default=0) + 1
    new = docs.select(F.col(key).alias("key"), text)
    if live:
        new = new.join(read(spark, path, "postings", [r.batch for r in live], [_bucket_of_documents(spark)]).where("term = ''").select("key"), "key", "left_anti")
    words = new.select("key", tokens(text).alias("_w")).withColumn("dl", F.size("_w"))
    length = F.floor(F.log2(F.coalesce("dl", F.lit(0)) + F.lit(1)))
    block = (F.lit(batch) * 10_000 + length * 100 + F.pmod(F.xxhash64("key"), F.lit(PARTS))).cast("long")
    # each task writes a file for a bucket; `compact` deals them anew
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = F.concat(F.array(F.lit("")), F.coalesce("_w", F.array().cast("array<string>")))
    tf = counted(words.coalesce(tasks).select("key", "dl", block.alias("block"), every.alias("_w")))
    if new.groupBy("key").count().where("count > 1").limit(1).count():
        tf = tf.groupBy("key", "dl", "block", "term").agg(F.sum("tf").alias("tf"))
    _write(tf.select("key", "dl", "term", "tf", "block"), path, "postings", batch, deal=False)
    sizes = _summaries(spark, path, batch)
    _commit(spark, path, version + 1, [*[tuple(r[c] for c in ("batch", "n_docs", "n_dl", "total")) for r in live], (batch, *sizes)])
    return version + 1


def compact(spark: SparkSession, path: str) -> int:
    """Makes one batch of all; the tables of the others go once the new version counts."""
    version, live = versions(spark, path)
    if len(live) < 2:
        return version
    old, batch = [r.batch for r in live], max(r.batch for r in live) + 1
    _write(read(spark, path, "postings", old).drop("bucket", "batch"), path, "postings", batch)
    sizes = _summaries(spark, path, batch)
    _commit(spark, path, version + 1, [(batch, *sizes)])
    release(spark, *[f"{path}/{table}/batch={b}" for table in ("postings", "dictionary", "blocks") for b in old])
    return version + 1


def _bucket_of_documents(spark: SparkSession) -> int:
    return spark.range(1).select(F.lit("").alias("term")).select(bucket()).first()[0]


def search(spark: SparkSession, path: str, queries: DataFrame, query: str = "item_id", text: str = "text", top: int = 15, doc: str = "doc_id") -> DataFrame:
    """(query, doc, rank, score): what retrieval.bm25 finds in the documents of the index.

    The driver gets the numbers of the buckets that the queries touch, at most BUCKETS, and the sizes of the batches. The hits
    are at most `top` a query; they are written to a table, so that the index may change afterwards.
    """
    _, live = versions(spark, path)
    batches = [r.batch for r in live]
    n, avgdl = sum(r.n_docs for r in live), (sum(r.total for r in live) or 1) / (sum(r.n_dl for r in live) or 1)
    wanted, p_wanted = materialise(query_terms(queries, query, text).withColumn("bucket", bucket()), "bm25-queries")
    touched = sorted(r[0] for r in wanted.select("bucket").distinct().collect())
    keys = ["bucket", "term"]
    df = read(spark, path, "dictionary", batches, touched).join(wanted.select(*keys).distinct(), keys).groupBy(*keys).agg(F.sum("df").alias("df"))
    idf = F.log((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted, p_weighted = materialise(wanted.join(df, keys).select(query, *keys, (F.col("times") * idf).alias("weight")), "bm25-weights")
    limit = F.sum(F.greatest(F.lit(0.0), F.col("weight") * gain("max_tf", "min_dl", avgdl)))
    bounds, p_bounds = materialise(read(spark, path, "blocks", batches, touched).join(weighted, keys).groupBy(query, "block").agg(limit.alias("bound")).where("bound > 0"), "bm25-bounds")

    small = weighted.count() <= FEW and bounds.count() <= FEW
    side = F.broadcast if small else lambda d: d

    def scored(blocks: DataFrame) -> DataFrame:
        # the postings of the queries' terms in blocks that count go to the tasks of their documents, which sum up and rank
        own = read(spark, path, "postings", batches, touched).join(side(weighted.select(*keys).distinct()), keys, "left_semi").join(side(blocks.select("block").distinct()), "block", "left_semi").select("key", "block", "bucket", "term", "tf", "dl")
        hits = (own.repartition("key") if small else own).join(side(weighted), keys).join(side(blocks.select(query, "block")), [query, "block"])
        scores = hits.groupBy(query, F.col("key").alias(doc)).agg(F.sum(F.col("weight") * gain("tf", "dl", avgdl)).alias("score"))
        return ranked(scores, query, [F.round("score", 9).desc(), F.col(doc)], top)

    first = scored(ranked(bounds, query, [F.desc("bound"), F.col("block")], FIRST).drop("rank"))
    floor = first.groupBy(query).agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == top)
    still = bounds.join(floor, query, "left").where(F.col("bound") >= F.coalesce("floor", F.lit(0.0)) - SLACK)
    out, _ = materialise(scored(still).where("score > 0").select(query, doc, "rank", "score"), "bm25-hits")
    release(spark, p_wanted, p_weighted, p_bounds)
    return out
