"""Evaluation-score analytics over score rows.

Score rows have bench (normalised name), display_name, folder, model, developer, metric, evaluation_name, score and ord, a
sortable position that stands for the order of the files and of the results in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import ratio
from ..functions.names import normalize_name, suite_name


def keyed(scores: DataFrame, name: str = "display_name") -> DataFrame:
    return scores.withColumn("bench", normalize_name(name))


def in_order(value: str, ord_: str = "ord") -> Column:
    """The values of a group in order of position."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(ord_).alias("o"), F.col(value).alias("v")))), lambda s: s["v"])


def roll_up(scores: DataFrame) -> DataFrame:
    """One row for each benchmark: first-seen name, folders, urls and metrics in order, models, repository.

    The first repository stays, but a row whose source is a hub dataset overrides it, the last one of them.
    """
    hub = (F.col("source_type") == "hf_dataset") & F.col("hf_repo").isNotNull()
    last_hub, first = F.max_by(F.when(hub, F.col("hf_repo")), F.when(hub, F.col("ord"))), F.min_by("hf_repo", F.when(F.col("hf_repo").isNotNull(), F.col("ord")))
    return keyed(scores).groupBy("bench").agg(
        F.min_by("display_name", "ord").alias("name"),
        F.array_distinct(in_order("folder")).alias("folders"),
        F.array_distinct(F.flatten(in_order("urls"))).alias("urls"),
        F.array_distinct(in_order("metric")).alias("metrics"),
        F.count("*").alias("n_scores"),
        F.countDistinct("model").alias("num_models"),
        F.min_by("eval_library", F.when(F.col("eval_library").isNotNull(), F.col("ord"))).alias("eval_library"),
        F.coalesce(last_hub, first).alias("hf_repo"),
        F.when(F.max(hub), F.lit("hf_dataset")).otherwise(F.min_by("source_type", "ord")).alias("source_type"),
        F.min("ord").alias("pos"),
    )


def average_subjects(scores: DataFrame, least: int = 3) -> DataFrame:
    """Benchmarks with `least` or more evaluation names become per-model averages with their subject scores."""
    many = scores.groupBy("bench").agg(F.countDistinct("evaluation_name").alias("_subjects"))
    joined = scores.join(many, "bench")
    subjects = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.col("evaluation_name").alias("subject"), "score"))), lambda s: F.struct(s["subject"].alias("subject"), s["score"].alias("score")))
    merged = joined.where(F.col("_subjects") >= least).groupBy("bench", "model").agg(
        F.min_by("display_name", "ord").alias("display_name"), F.min_by("developer", "ord").alias("developer"), F.avg("score").alias("score"), subjects.alias("subject_scores"), F.min("ord").alias("ord")
    )
    merged = merged.withColumn("metric", F.lit("average_across_subjects")).withColumn("evaluation_name", F.col("display_name"))
    single = joined.where(F.col("_subjects") < least)
    names = ["bench", "display_name", "model", "developer", "metric", "evaluation_name", "score", "ord"]
    none = F.lit(None).cast("array<struct<subject:string,score:double>>")
    return merged.select(*names, "subject_scores").unionByName(single.select(*names, none.alias("subject_scores")))


def summary(scores: DataFrame, top: int = 5, respect_direction: bool = False) -> DataFrame:
    """Per benchmark the metric with most scores (the first seen of equals) with n, mean, sample deviation, least and greatest.

    The leaders of that metric are in `leaders`, best first. By default larger scores lead, whatever the metric's direction.
    """
    stats = scores.groupBy("bench", "metric").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.coalesce(F.stddev_samp("score"), F.lit(0.0)).alias("sd"), F.min("score").alias("least"), F.max("score").alias("greatest"), F.min("ord").alias("first_ord"))
    primary = stats.withColumn("_r", F.row_number().over(Window.partitionBy("bench").orderBy(F.desc("n"), "first_ord"))).where("_r = 1").drop("_r")
    best = leaders(scores, top, respect_direction).groupBy("bench", "metric").agg(F.array_sort(F.collect_list(F.struct("rank", "model", "score"))).alias("leaders"))
    four = lambda c: F.round(c, 4).alias(c)
    return primary.join(best, ["bench", "metric"], "left").select("bench", "metric", "n", four("mean"), four("sd"), four("least"), four("greatest"), "leaders")


def leaders(scores: DataFrame, top: int = 5, respect_direction: bool = False) -> DataFrame:
    """The best models by (bench, metric); the planner limits each task's groups before the shuffle."""
    value = F.when(F.col("lower_is_better"), -F.col("score")).otherwise(F.col("score")) if respect_direction else F.col("score")
    rank = F.row_number().over(Window.partitionBy("bench", "metric").orderBy(value.desc(), "ord"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= top)


def suite_statistics(scores: DataFrame, members: DataFrame) -> DataFrame:
    """Per suite (folder, bench) the distinct models and metrics of its members."""
    return members.join(scores.drop("folder"), "bench").groupBy("folder").agg(F.countDistinct("model").alias("num_models"), F.array_sort(F.collect_set("metric")).alias("metrics"), F.countDistinct("bench").alias("members"))


def appears_in(members: DataFrame) -> DataFrame:
    """The suites of each benchmark."""
    return members.groupBy("bench").agg(F.array_sort(F.collect_set("folder")).alias("suites"))


def filtered(benchmarks: DataFrame, members: DataFrame, names: list[str]) -> DataFrame:
    """Benchmarks with one of the names, and the members of suites with one of them."""
    wanted = [n.strip().lower() for n in names]
    suites = members.where(F.lower("folder").isin(*wanted)).select("bench")
    own = benchmarks.where(F.lower("name").isin(*wanted)).select("bench")
    return benchmarks.join(own.union(suites).distinct(), "bench", "left_semi")


def pair_sample(members: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """(key, a, b): pairs of a group's members, each with the later one second; of more than `limit` evenly spaced ones in order.

    The pairs are numbered without being made: a member begins as many as come after it. The numbers to take follow from the
    group's size, so a group of n costs at most `limit` * n rows, not n * n.
    """
    by = Window.partitionBy(key)
    own = members.select(key, "bench", F.row_number().over(by.orderBy("pos")).alias("_at"), F.count("*").over(by).alias("_n"))
    own = own.withColumn("_c", F.col("_n") - F.col("_at")).withColumn("_before", F.sum("_c").over(by.orderBy("bench", "_at").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c"))
    total = (F.col("_n") * (F.col("_n") - 1) / 2).cast("long")
    step = F.when(total > limit, F.floor(total / limit)).otherwise(F.lit(1)).cast("long")
    wanted = members.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key, F.explode(F.transform(F.sequence(F.lit(0), F.least(total, F.lit(limit)).cast("int") - 1), lambda j: j * step)).alias("_p"))
    first = wanted.join(own, key).where((F.col("_p") >= F.col("_before")) & (F.col("_p") < F.col("_before") + F.col("_c"))).select(key, "_p", F.col("bench").alias("a"), F.col("_at").alias("_a"), (F.col("_p") - F.col("_before") + 1).alias("_k"))
    second = first.join(own.select(key, F.col("bench").alias("b"), F.col("_at").alias("_b")), key).where("_b > _a").withColumn("_r", F.row_number().over(Window.partitionBy(key, "_p").orderBy("b", "_b")))
    return second.where("_r = _k").select(key, "a", "b")


def collapse_votes(members: DataFrame, key: str = "folder", prefix: int = 4, least: float = 70.0) -> DataFrame:
    """Whether the benchmarks of each group are subjects of one benchmark: two of four signals.

    members has (key, bench, pos, urls, hf_repo). The signals are columns, so that a caller can ask for more of them.
    """
    least_name, greatest = F.min("bench"), F.max("bench")
    groups = members.groupBy(key).agg(
        F.count("*").alias("members"),
        least_name.alias("least_name"),
        greatest.alias("greatest_name"),
        F.size(F.array_distinct(F.flatten(F.collect_list("urls")))).alias("n_urls"),
        F.countDistinct("hf_repo").alias("n_repos"),
        F.array_sort(F.collect_list("bench")).alias("benches"),
    )
    shared = (F.length("least_name") >= prefix) & (F.substring("least_name", 1, prefix) == F.substring("greatest_name", 1, prefix))
    alike = pair_sample(members, key).groupBy(key).agg(F.avg(ratio("a", "b")).alias("similarity"))
    flags = [shared.alias("same_prefix"), (F.col("n_urls") == 1).alias("same_url"), (F.col("n_repos") == 1).alias("same_repo"), F.coalesce(F.col("similarity") > least, F.lit(False)).alias("similar")]
    out = groups.where("members >= 2").join(alike, key, "left").select(key, "members", "benches", "least_name", "greatest_name", "similarity", *flags)
    signals = sum((F.col(c).cast("int") for c in ("same_prefix", "same_url", "same_repo", "similar")), F.lit(0))
    return out.withColumn("signals", signals).withColumn("collapse", F.col("signals") >= 2).withColumn("merged_name", suite_name(key, "least_name", "greatest_name"))


def folder_members(benchmarks: DataFrame) -> DataFrame:
    """(folder, bench, pos, urls, hf_repo) of rolled-up benchmarks."""
    return benchmarks.select(F.explode("folders").alias("folder"), "bench", F.col("bench").alias("pos"), "urls", "hf_repo")


def baseline_sentence(summaries: DataFrame, models: str = "n", top: int = 3) -> DataFrame:
    """The summary of each benchmark in two sentences, the second with its best models."""
    best = F.array_join(F.transform(F.slice("leaders", 1, top), lambda p: F.concat(p["model"], F.lit(" ("), F.format_string("%.4f", p["score"]), F.lit(")"))), ", ")
    text = F.concat(F.format_string("Based on %d model evaluations: mean %s = %.4f (std = %.4f). Top performers: ", F.col(models), F.col("metric"), F.col("mean"), F.col("sd")), best, F.lit("."))
    return summaries.select("bench", text.alias("sentence"))
