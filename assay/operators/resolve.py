"""Entity resolution: lookups with overrides, fuzzy matches, anti-join cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import partial_ratio
from ..functions.names import normalize_name, slug
from ..storage import materialise, release
from .similarity_join import best_partners

# Hub repositories that names stand for; None means that there is none.
REPOSITORIES = {
    "raft": "ought/raft",
    "quac": "allenai/quac",
    "math": "hendrycks/competition_math",
    "math level 5": "hendrycks/competition_math",
    "naturalquestions": "google-research-datasets/natural_questions",
    "naturalquestions (open-book)": "google-research-datasets/natural_questions",
    "naturalquestions (closed-book)": "google-research-datasets/natural_questions",
    "cnn/dailymail": "abisee/cnn_dailymail",
    "ms marco": "microsoft/ms_marco",
    "ms marco (trec)": "microsoft/ms_marco",
    "wmt 2014": None,
    "anthropic rlhf dataset": "Anthropic/hh-rlhf",
    "best chatgpt prompts": "fka/awesome-chatgpt-prompts",
    "koala test dataset": "HuggingFaceH4/Koala-test-set",
    "theory_of_mind": "grimulkan/theory-of-mind",
}
# Names that sum up a suite.
AGGREGATES = ("capabilities", "classic", "instruct", "lite", "overall", "mean")
MIN_DOWNLOADS, TRUSTED_DOWNLOADS = 500, 5000


def with_override(rows: DataFrame, overrides: DataFrame, key: Column, value: str) -> DataFrame:
    """`value` from overrides (key, value) where the key is known, a null there included, else the row's own."""
    side = overrides.select(F.col("key").alias("_k"), F.col("value").alias("_v"))
    return rows.join(side, key == F.col("_k"), "left").withColumn("is_override", F.col("_k").isNotNull()).withColumn(value, F.when(F.col("_k").isNotNull(), F.col("_v")).otherwise(F.col(value))).drop("_k", "_v")


def repository_overrides(spark) -> DataFrame:
    return spark.createDataFrame(list(REPOSITORIES.items()), "key string, value string")


def exact_then_suffix(rows: DataFrame, index: DataFrame, key: str, value: str) -> DataFrame:
    """value of the index (key, value, ord) for an equal key, else for the first with an equal last part, whatever the case."""
    tail = lambda c: F.lower(F.element_at(F.split(c, "/"), -1))
    exact = index.groupBy(F.col("key").alias("_k")).agg(F.min_by("value", "ord").alias("_exact"))
    loose = index.groupBy(tail("key").alias("_t")).agg(F.min_by("value", "ord").alias("_loose"))
    return rows.join(exact, F.col(key) == F.col("_k"), "left").join(loose, tail(key) == F.col("_t"), "left").withColumn(value, F.coalesce("_exact", "_loose")).drop("_k", "_t", "_exact", "_loose")


def fuzzy_match(left: DataFrame, right: DataFrame, name: str, other: str, least: float = 80.0, cell: int | None = None) -> DataFrame:
    """(name, other, similarity): an equal normalised name, else the best similarity of at least `least`; one left row for each right.

    See similarity_join for how partners are found. `cell`, once the size of a task's work, has no effect any more.
    """
    a = left.select(F.col(name).alias("a"), normalize_name(name).alias("na")).distinct()
    b = right.select(F.col(other).alias("b"), normalize_name(other).alias("nb")).distinct()
    best = best_partners(a, b, least)
    one = best.withColumn("_r", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("similarity"), "a"))).where("_r = 1").drop("_r")
    return one.select(F.col("a").alias(name), F.col("b").alias(other), F.least(F.lit(100.0), "similarity").alias("similarity"))


def strict_enough(name: str, similarity: str, has_term: Column) -> Column:
    """Short names need 65 and, below 80, a term of the domain; longer ones 50."""
    short = F.length(F.regexp_replace(F.col(name), "[-_]", "")) <= 5
    s = F.col(similarity)
    return F.when(short, (s >= 65) & ((s >= 80) | has_term)).otherwise(s >= 50)


def best_partial(names: DataFrame, titles: DataFrame, name: str, title: str, key: str) -> DataFrame:
    """(name, similarity): the best partial similarity with a title of the same key."""
    return names.join(titles, key).groupBy(name).agg(F.max(partial_ratio(F.lower(name), F.lower(title))).alias("similarity"))


def not_done(rows: DataFrame, done: DataFrame, name: str = "name", canonical: str = "canonical_id", key: str = "key") -> DataFrame:
    """Rows whose canonical id, slug, and parent's slug are none of the keys done."""
    known = done.select(F.col(key).alias("_k")).distinct()
    parent = F.when(F.col(name).contains(" - "), slug(F.substring_index(F.col(name), " - ", 1)))
    for made in (F.col(canonical), slug(name), parent):
        rows = rows.withColumn("_m", made).join(known, F.col("_m") == F.col("_k"), "left_anti").drop("_m")
    return rows


def new_items(found: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return found.select(key).distinct().join(known.select(key), key, "left_anti")


def substring_repository(rows: DataFrame, hub: DataFrame, name: str, least: int = MIN_DOWNLOADS, trusted: int = TRUSTED_DOWNLOADS) -> DataFrame:
    """(name, repo): of a name's search hits (name, repo, downloads, place) the first that contains it or is contained in it
    and has enough downloads, else the first hit if it has very many."""
    short = normalize_name(F.element_at(F.split("repo", "/"), -1))
    fits = (short.contains(normalize_name(name)) | normalize_name(name).contains(short)) & (F.col("downloads") >= least)
    sure = (F.col("place") == 1) & (F.col("downloads") >= trusted)
    picked = hub.where(fits | sure).groupBy(name).agg(F.min_by("repo", F.struct(F.when(fits, 0).otherwise(1), "place")).alias("repo"))
    return rows.join(picked, name, "left")


def first_tier(tiers: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """(value, name) of the first tier with a value."""
    named = F.when(F.lit(False), F.lit(""))
    for name, c in tiers:
        named = named.when(c.isNotNull(), F.lit(name))
    return F.coalesce(*[c for _, c in tiers]), named


def closure(edges: DataFrame, start: DataFrame, depth: int | None = None, src: str = "src", dst: str = "dst") -> DataFrame:
    """(root, node, depth): what is reachable over edges; each node once, at its least depth. Stops when nothing is new.

    With `depth` it stops after so many rounds. Each round is a table in the shared folder, so no lineage grows; the tables of
    the rounds are the result and stay.
    """
    spark = edges.sparkSession
    edges, p_edges = materialise(edges.select(F.col(src).alias("_src"), F.col(dst).alias("node")).distinct(), "closure-edges")
    front, path = materialise(start.select(F.col("root"), F.col("root").alias("node"), F.lit(0).alias("depth")).distinct(), "closure")
    found, paths, d = front, [path], 0
    while depth is None or d < depth:
        d += 1
        step = front.select("root", F.col("node").alias("_src")).join(edges, "_src").select("root", "node").distinct()
        front, path = materialise(step.join(found.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(d)), "closure")
        if not front.limit(1).count():
            release(spark, path)
            break
        paths.append(path)
        found = spark.read.schema(front.schema).parquet(*paths)
    release(spark, p_edges)
    return found
