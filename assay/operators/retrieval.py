"""Evidence retrieval: chunks, BM25, dense search, keyword filter, and their fusion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from . import blocks

K1, B = 1.5, 0.75
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def stride_chunks(docs: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Chunks of `size` characters, each beginning size - overlap after the one before."""
    step = size - overlap
    n = F.greatest(F.lit(1), F.ceil((F.length(text) - overlap) / F.lit(step)))
    starts = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: i * step + 1)
    return docs.select("*", F.posexplode(starts).alias("chunk", "_at")).withColumn("chunk_text", F.substring(F.col(text), F.col("_at"), F.lit(size))).drop("_at")


def split_text(text: str, size: int, overlap: int, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of at most `size` characters, cut at the coarsest separator that serves, with an overlap of whole parts."""
    if len(text) <= size:
        return [text] if text.strip() else []
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    mark, finer = separators[at], separators[at + 1 :]
    parts = list(text) if mark == "" else [p + mark if i + 1 < n else p for n in [text.count(mark) + 1] for i, p in enumerate(text.split(mark))]
    out: list[str] = []
    held: list[str] = []
    length = 0
    for part in parts:
        if len(part) > size and finer:
            if held:
                out.append("".join(held))
            out += split_text(part, size, overlap, finer)
            held, length = [], 0
            continue
        if length + len(part) > size and held:
            out.append("".join(held))
            while held and (length > overlap or length + len(part) > size):
                length -= len(held.pop(0))
        held.append(part)
        length += len(part)
    if held:
        out.append("".join(held))
    return [p.strip() for p in out if p.strip()]


def recursive_chunks(docs: DataFrame, key: str, text: str = "text", parent: tuple[int, int] = (2048, 204), child: tuple[int, int] = (512, 64)) -> DataFrame:
    """(key, parent_idx, child_idx, text, parent_text): children of parents, both cut recursively."""

    @F.pandas_udf("array<struct<parent_idx:int,child_idx:int,text:string,parent_text:string>>")
    def cut(x: pd.Series) -> pd.Series:
        return x.map(lambda t: [{"parent_idx": i, "child_idx": j, "text": c, "parent_text": p} for i, p in enumerate(split_text(t or "", *parent)) for j, c in enumerate(split_text(p, *child))])

    return docs.select(key, F.explode(cut(text)).alias("c")).select(key, "c.*")


def split_chunks(docs: DataFrame, key: str | list[str], size: int = 1000, overlap: int = 200, separators: tuple[str, ...] = ("\n\n", "\n", " ", ""), text: str = "text") -> DataFrame:
    """(key, chunk, text): pieces of whole parts, cut at the coarsest separator that serves."""

    @F.pandas_udf("array<string>")
    def cut(x: pd.Series) -> pd.Series:
        return x.map(lambda t: split_text(t or "", size, overlap, separators))

    return docs.select(*([key] if isinstance(key, str) else key), F.posexplode(cut(text)).alias("chunk", "text"))


def postings(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, dl, term, tf)."""
    words = docs.select(key, tokens(text).alias("_w")).withColumn("dl", F.size("_w"))
    return words.select(key, "dl", F.explode("_w").alias("term")).groupBy(key, "dl", "term").agg(F.count("*").alias("tf"))


def query_terms(queries: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term, times): a query's terms with how often they occur in it."""
    return queries.select(key, F.explode(tokens(text)).alias("term")).groupBy(key, "term").agg(F.count("*").alias("times"))


def bm25(docs: DataFrame, queries: DataFrame, doc: str = "doc_id", query: str = "item_id", text: str = "text", top: int = 15, terms_bound: int = 200_000) -> DataFrame:
    """(query, doc, rank, score): the best `top` documents of each query, of them those with a positive score.

    idf is ln((N - df + 0.5) / (df + 0.5)) and may be negative, so scores are filtered after the cut. Postings are reduced to
    the queries' terms before they are counted. Up to `terms_bound` terms of all queries are broadcast; else all joins shuffle.
    """
    wanted = query_terms(queries, query, text)
    terms = wanted.select("term").distinct()
    few = wanted.count() <= terms_bound
    words = docs.select(doc, tokens(text).alias("_w")).withColumn("dl", F.size("_w"))
    corpus = words.agg(F.count("*").alias("n_docs"), F.avg("dl").alias("avgdl"))
    tf = words.select(doc, "dl", F.explode("_w").alias("term")).join(F.broadcast(terms) if few else terms, "term", "left_semi").groupBy(doc, "dl", "term").agg(F.count("*").alias("tf"))
    # reading tf keeps the columns, and so the shuffle, the same as those of the postings themselves
    df = tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = wanted.join(df, "term").crossJoin(F.broadcast(corpus)).select(query, "term", "avgdl", (F.col("times") * idf).alias("_weight"))
    part = F.col("_weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    # all terms of a document in one task: it sums up and ranks there, and hands on its best only
    own = tf.repartition(doc).join(F.broadcast(weighted), "term") if few else tf.join(weighted, "term")
    hits = own.groupBy(query, doc).agg(F.sum(part).alias("score"))
    return ranked(hits, query, [F.round("score", 9).desc(), F.col(doc)], top).where("score > 0")


def ranked(rows: DataFrame, key: str | list[str], order: list[Column], top: int) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)


def cosine(a: str, b: str) -> Column:
    """Dot product of unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def dense_search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", query: str = "query_id", top: int = 15, rows_bound: int = 100_000) -> DataFrame:
    """(query, key, rank, score): the most similar vectors of each query.

    Every query meets every vector, block by block (see blocks); the queries' blocks go to the vectors' at most `rows_bound` queries at
    a time, and each pair of blocks keeps `top` hits. Null vectors, and those of another length than the queries or with elements that
    are no usual numbers, are scored pair by pair, null last.
    """
    doubles = tuple("array<double>" in dict(d.dtypes)["embedding"] for d in (vectors, queries))
    n, size, nulls = queries.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0)), F.count_if(F.col("embedding").isNull())).first()
    usual, given = blocks.plain("embedding", size), F.col("embedding").isNotNull()
    odd = lambda d: d.where(given & ~usual)
    counted = lambda d: d.agg(F.count_if(~given), F.count_if(given & ~usual)).first()
    null_vectors, odd_vectors = counted(vectors)
    odd_queries = counted(queries)[1]
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the products take much longer than reading, so the blocks are dealt to all tasks
    many = blocks.packed(vectors.where(usual).select(key, "embedding"), key, copies=top).repartition(tasks)
    out, parts = None, max(1, -(-n // rows_bound))
    for b in range(parts):
        some = queries.where(F.pmod(F.xxhash64(query), F.lit(parts)) == b) if parts > 1 else queries
        asked = blocks.packed(some.where(usual).select(query, "embedding").repartition(max(1, -(-min(n, rows_bound) // blocks.BLOCK))), query)
        best = ranked(blocks.nearest(many.crossJoin(F.broadcast(asked.withColumnRenamed("embedding", "_q"))), key, query, top, doubles), query, [F.desc("score"), F.col(key)], top)
        out = best if out is None else out.unionByName(best)
    further = []
    least = lambda d: d.select(key).orderBy(key).limit(top)
    if null_vectors:
        further.append(least(vectors.where(~given)).crossJoin(queries.where(given).select(query)).select(query, key, F.lit(None).cast("double").alias("score")))
    if nulls:
        further.append(least(vectors).crossJoin(queries.where(~given).select(query)).select(query, key, F.lit(None).cast("double").alias("score")))
    for v, q, any_ in ((odd(vectors), queries.where(given), odd_vectors), (vectors.where(usual), odd(queries), odd_queries)):
        if any_:
            further.append(v.select(key, "embedding").crossJoin(q.select(query, F.col("embedding").alias("_q"))).select(query, key, cosine("embedding", "_q").alias("score")))
    if not further:
        return out
    every = out.drop("rank")
    for d in further:
        every = every.unionByName(d)
    return ranked(every, query, [F.desc("score"), F.col(key)], top).select(*out.columns)


def mmr(candidates: DataFrame, query: str, key: str, k: int, weight: float = 0.8) -> DataFrame:
    """(query, key, step): greedy maximal marginal relevance over a query's few candidates (key, embedding, score)."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", key], ascending=[False, True]).reset_index(drop=True)
        vectors = np.array(pdf["embedding"].tolist(), float)
        score, chosen, near = pdf["score"].to_numpy(), [], np.full(len(pdf), -np.inf)
        while len(chosen) < min(k, len(pdf)):
            value = score if not chosen else weight * score - (1 - weight) * near
            value = np.where(np.isin(np.arange(len(pdf)), chosen), -np.inf, value)
            best = int(value.argmax())
            chosen.append(best)
            near = np.maximum(near, vectors @ vectors[best])
        return pd.DataFrame({query: pdf[query].iloc[chosen].to_numpy(), key: pdf[key].iloc[chosen].to_numpy(), "step": np.arange(1, len(chosen) + 1)})

    kinds = dict(candidates.dtypes)
    return candidates.select(query, key, "embedding", "score").groupBy(query).applyInPandas(pick, f"{query} {kinds[query]}, {key} {kinds[key]}, step int")


def keyword_hits(docs: DataFrame, words: Column, text: str = "text") -> DataFrame:
    """Documents that contain one of the words, whatever the case."""
    return docs.where(F.exists(words, lambda w: F.lower(F.col(text)).contains(F.lower(w))))


def fuse(sources: list[DataFrame], query: str, content: str, cap: int = 20) -> DataFrame:
    """Union of candidate lists in order of priority; of equal contents the first stays; `cap` for each query."""
    parts = [s.withColumn("prio", F.lit(i)) for i, s in enumerate(sources)]
    all_rows = parts[0]
    for p in parts[1:]:
        all_rows = all_rows.unionByName(p)
    first = Window.partitionBy(query, F.md5(F.col(content))).orderBy("prio", "rank")
    kept = all_rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(query).orderBy("prio", "rank"))).where(F.col("place") <= cap)


def grade(candidates: DataFrame, query: str, order: str, text: str = "text", least: int = 20) -> DataFrame:
    """Drops short texts and those that contain, or are contained in, one kept before them for the same query."""

    def pick(frames: Iterator[pd.DataFrame] | pd.DataFrame) -> pd.DataFrame:
        pdf = frames.sort_values(order)
        kept: list[str] = []
        take = []
        for t in pdf[text]:
            t = (t or "").strip()
            good = len(t) >= least and not any(t in k or k in t for k in kept)
            take.append(good)
            if good:
                kept.append(t)
        return pdf[take]

    return candidates.groupBy(query).applyInPandas(pick, candidates.schema)


def rerank(candidates: DataFrame, query: str, score: str, pool: int = 10, least: float = 6.0, top: int = 3) -> DataFrame:
    """Of the first `pool` candidates those a provider scored `least` or more, best first; the first `top` where it scored none."""
    rows = candidates.where(F.col("place") <= pool).withColumn("_any", F.max(score).over(Window.partitionBy(query)))
    return ranked(rows.where((F.col(score) >= least) | F.col("_any").isNull()).drop("_any"), query, [F.desc(score), F.col("place")], top)


def widen(chunks: DataFrame, parents: DataFrame, keys: list[str]) -> DataFrame:
    """Child chunks with their parent's text, joined only for the winners."""
    return chunks.join(parents, keys, "left")


def budget(parts: DataFrame, key: str, order: str, limit: int = 25_000, least: int = 100, text: str = "text") -> DataFrame:
    """Parts in order up to `limit` characters; the first that does not fit is cut if more than `least` remain."""
    total = F.sum(F.length(text)).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    before = total - F.length(text)
    rows = parts.withColumn("_before", before).withColumn("_total", total)
    fits = F.col("_total") <= limit
    cut = (F.col("_before") < limit) & (F.lit(limit) - F.col("_before") > least)
    return rows.where(fits | cut).withColumn(text, F.when(fits, F.col(text)).otherwise(F.substring(F.col(text), F.lit(1), F.lit(limit) - F.col("_before")))).drop("_before", "_total")
