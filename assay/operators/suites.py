"""Which benchmarks are subjects of one: `Parent - Child` names and folders, merged or kept as suites.

Benchmarks have (bench, name, pos, folders, urls, metrics, hf_repo, source_type, eval_library, num_models), scores
(bench, display_name, model, developer, metric, evaluation_name, score, subject_scores, ord). `pos` and `ord` sort by the order in
which files and results came.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import normalize_name, strip
from ..storage import materialise
from .evaluations import collapse_votes

MARK = " - "


@dataclass
class State:
    benchmarks: DataFrame
    scores: DataFrame


def child_label(name: str) -> Column:
    """What comes after the first ` - `, or the whole name."""
    at = F.instr(name, MARK)
    return strip(F.when(at > 0, F.substr(F.col(name), at + len(MARK))).otherwise(F.col(name)))


def _in_order(rows: DataFrame, value: str, distinct: bool = True) -> Column:
    """The arrays `value` of a group's members one after the other."""
    whole = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct("nth", F.col(value).alias("v"))))), lambda s: s["v"]))
    return F.array_distinct(whole) if distinct else whole


def member_scores(state: State, groups: DataFrame) -> DataFrame:
    """(group, nth, is_overall, model, developer, metric, score, ord, subject): the scores of all members."""
    named = groups.select("group", "nth", "is_overall", "bench", child_label("name").alias("subject"))
    return named.join(state.scores.select("bench", "model", "developer", "metric", "score", "ord"), "bench")


def subjects_of(rows: DataFrame) -> DataFrame:
    """(group, model, subject_scores) in the order of the members and their scores."""
    entries = F.array_sort(F.collect_list(F.struct("nth", "ord", "subject", "score")))
    return rows.groupBy("group", "model").agg(F.transform(entries, lambda s: F.struct(s["subject"].alias("subject"), s["score"].alias("score"))).alias("subject_scores"))


def merge(state: State, groups: DataFrame) -> State:
    """Replaces the members of each group (group, merged_name, folder, library, bench, name, nth, is_overall) by one benchmark.

    A model's score is that of the "Overall" member, if there is one, else the mean over all members. Metrics and urls are the
    members' in order, the repository the first known.
    """
    groups, _ = materialise(groups, "suite-groups")
    rows, _ = materialise(member_scores(state, groups), "suite-rows")
    names = groups.groupBy("group").agg(F.first("merged_name").alias("merged_name"), F.max("is_overall").alias("has_overall"))
    own = rows.join(names.where("has_overall").select("group"), "group", "left_semi").where("is_overall").select("group", "model", "developer", "score", F.coalesce("metric", F.lit("overall")).alias("metric"), "ord")
    first = F.struct("nth", "ord")
    mean = rows.join(names.where("NOT has_overall").select("group"), "group", "left_semi").groupBy("group", "model").agg(F.min_by("developer", first).alias("developer"), F.avg("score").alias("score"), F.min_by("ord", first).alias("ord"))
    made = own.unionByName(mean.withColumn("metric", F.lit("average_across_subjects"))).join(subjects_of(rows), ["group", "model"], "left").join(names, "group")
    made = made.select(normalize_name("merged_name").alias("bench"), F.col("merged_name").alias("display_name"), "model", "developer", "metric", F.col("merged_name").alias("evaluation_name"), "score", "ord", "subject_scores", "group")
    made, _ = materialise(made, "suite-scores")
    members = groups.join(state.benchmarks.drop("name"), "bench")
    first_of = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("nth")))
    merged = members.groupBy("group").agg(
        F.first("merged_name").alias("name"), F.array(F.first("folder")).alias("folders"), _in_order(members, "urls").alias("urls"), _in_order(members, "metrics").alias("metrics"),
        first_of("hf_repo").alias("hf_repo"), F.first("library").alias("eval_library"), F.max("pos").alias("pos"),
    )
    counted = made.groupBy("group").agg(F.count("*").alias("num_models"), F.count("*").alias("n_scores"))
    merged = merged.join(counted, "group", "left").select(
        normalize_name("name").alias("bench"), "name", "folders", "urls", "metrics", F.coalesce("n_scores", F.lit(0)).alias("n_scores"), F.coalesce("num_models", F.lit(0)).alias("num_models"), "eval_library", "hf_repo",
        F.when(F.col("hf_repo").isNotNull(), "hf_dataset").otherwise("other").alias("source_type"), "pos",
    )
    gone = groups.select("bench").distinct()
    # a merged benchmark takes the place of one that has just its name
    taken = merged.select("bench")
    left = lambda d: d.join(gone, "bench", "left_anti").join(taken, "bench", "left_anti")
    benchmarks, _ = materialise(left(state.benchmarks).unionByName(merged), "benchmarks")
    scores, _ = materialise(left(state.scores).unionByName(made.drop("group")), "scores")
    return State(benchmarks, scores)


def enrich(state: State, groups: DataFrame) -> State:
    """Gives the scores of each standalone benchmark (target) those of its group's members as subject scores; members go."""
    groups, _ = materialise(groups, "suite-groups")
    subjects = subjects_of(member_scores(state, groups)).join(groups.select("group", "target").distinct(), "group").select(F.col("target").alias("bench"), "model", F.col("subject_scores").alias("_subs"))
    gone = groups.select("bench").distinct()
    scores = state.scores.join(gone, "bench", "left_anti").join(subjects, ["bench", "model"], "left").withColumn("subject_scores", F.coalesce("_subs", "subject_scores")).drop("_subs")
    members = groups.join(state.benchmarks.select("bench", "urls"), "bench")
    more = members.groupBy(F.col("target").alias("bench")).agg(_in_order(members, "urls").alias("_more"))
    benchmarks = state.benchmarks.join(gone, "bench", "left_anti").join(more, "bench", "left").withColumn("urls", F.when(F.col("_more").isNull(), F.col("urls")).otherwise(F.array_union("urls", "_more"))).drop("_more")
    benchmarks, _ = materialise(benchmarks, "benchmarks")
    scores, _ = materialise(scores, "scores")
    return State(benchmarks, scores)


def name_subgroups(state: State, metadata: DataFrame) -> State:
    """Merges benchmarks named `Parent - Child`, in groups of two or more that pass the vote.

    Where the parent is a benchmark of its own, it gets the children's scores as subject scores instead.
    """
    named = state.benchmarks.where(F.col("name").contains(MARK)).withColumn("group", strip(F.substring_index("name", MARK, 1)))
    nth = F.row_number().over(Window.partitionBy("group").orderBy("pos"))
    overall = F.lower(child_label("name")).contains("overall")
    # of several "Overall" members the first counts
    first = F.row_number().over(Window.partitionBy("group", "_o").orderBy("pos")) == 1
    members = named.withColumn("nth", nth).withColumn("_o", overall).withColumn("is_overall", F.col("_o") & first)
    votes = collapse_votes(members.select(F.col("group").alias("parent"), "bench", F.col("nth").alias("pos"), "urls", "hf_repo"), "parent").where("collapse").select(F.col("parent").alias("group"))
    chosen, _ = materialise(members.join(votes, "group", "left_semi").select("group", "bench", "name", "nth", "is_overall", "folders"), "subgroups")
    if not chosen.limit(1).count():
        return state
    parents = state.benchmarks.select(F.col("name").alias("group"), F.col("bench").alias("target")).where(~F.col("group").contains(MARK))
    known = chosen.join(parents, "group")
    if known.limit(1).count():
        state = enrich(state, known.select("group", "target", "bench", "name", "nth", "is_overall"))
    folder = chosen.where("nth = 1").select("group", F.coalesce(F.get("folders", F.lit(0)), F.lit("unknown")).alias("folder"))
    fresh = chosen.drop("folders").join(parents, "group", "left_anti").join(folder, "group").join(metadata.select("folder", F.col("eval_library").alias("library")), "folder", "left").withColumn("merged_name", F.col("group"))
    return merge(state, fresh) if fresh.limit(1).count() else state


def folders(state: State, metadata: DataFrame, collapse: bool = True) -> tuple[State, DataFrame, DataFrame]:
    """(state, suites (folder, members, urls, eval_library), votes): folders of several benchmarks, merged if their vote
    says so, else suites.

    The members of a folder are those before any merge; a folder is judged after all earlier ones that share a benchmark
    with it, so what they have merged is gone for it. Folders that share none are judged in one round.
    """
    members = state.benchmarks.select("bench", "name", "pos", F.posexplode("folders").alias("_i", "folder"))
    several = members.groupBy("folder").agg(F.count("*").alias("_n"), F.min(F.struct("pos", "_i")).alias("_at")).where("_n > 1")
    members, _ = materialise(members.join(several, "folder").withColumn("nth", F.row_number().over(Window.partitionBy("folder").orderBy("pos"))).select("folder", "_at", "bench", "name", "nth"), "folder-members")
    library = metadata.select("folder", F.col("eval_library").alias("library"))
    pending, votes, merged = members.select("folder", "_at").distinct(), None, None
    while True:
        pending, _ = materialise(pending, "folders-pending")
        if not pending.limit(1).count():
            break
        open_ = members.join(pending.select("folder"), "folder", "left_semi")
        shared = open_.alias("a").join(open_.alias("b"), (F.col("a.bench") == F.col("b.bench")) & (F.col("b._at") < F.col("a._at"))).select(F.col("a.folder").alias("folder")).distinct()
        ready, _ = materialise(pending.join(shared, "folder", "left_anti"), "folders-ready")
        now = open_.join(ready.select("folder"), "folder", "left_semi").join(state.benchmarks.select("bench", "urls", "hf_repo"), "bench", "left")
        said, _ = materialise(collapse_votes(now.select("folder", "bench", F.col("nth").alias("pos"), "urls", "hf_repo")).withColumn("collapse", F.col("collapse") & F.lit(collapse)), "folder-votes")
        votes = said if votes is None else votes.unionByName(said)
        chosen = now.join(said.where("collapse").select("folder", "merged_name"), "folder").join(library, "folder", "left").select(F.col("folder").alias("group"), "merged_name", "folder", "library", "bench", "name", "nth", F.lit(False).alias("is_overall"))
        if chosen.limit(1).count():
            state = merge(state, chosen)
        pending = pending.join(ready.select("folder"), "folder", "left_anti")
    if votes is None:
        votes = collapse_votes(members.join(state.benchmarks.select("bench", "urls", "hf_repo"), "bench").select("folder", "bench", F.col("nth").alias("pos"), "urls", "hf_repo"))
    suites = members.join(votes.where("NOT collapse").select("folder"), "folder", "left_semi").groupBy("folder").agg(F.array_sort(F.collect_list("name")).alias("members"))
    return state, suites.join(metadata, "folder", "left").select("folder", "members", F.coalesce("urls", F.array().cast("array<string>")).alias("urls"), "eval_library"), votes


def benchmark_inputs(state: State, suites: DataFrame, summaries: DataFrame, overrides: DataFrame) -> DataFrame:
    """(name, hf_repo, extracted_ids, metadata): what the card pipeline starts from, one row for each benchmark.

    `overrides` (key, value) say which repository a name stands for, null for none; summaries are those of its scores.
    """
    inside = suites.select(F.explode("members").alias("name"), "folder").groupBy("name").agg(F.array_sort(F.collect_set("folder")).alias("appears_in"))
    side = overrides.select(F.col("key").alias("_k"), F.col("value").alias("_v"))
    rows = state.benchmarks.join(summaries.withColumnRenamed("bench", "_b"), F.col("bench") == F.col("_b"), "left").join(inside, "name", "left").join(side, F.lower("name") == F.col("_k"), "left")
    repo = F.when(F.col("_k").isNotNull(), F.col("_v")).otherwise(F.col("hf_repo"))
    summary = F.when(F.col("_b").isNotNull(), F.struct(F.col("num_models").alias("total_models_evaluated"), F.col("metric").alias("primary_metric"), F.struct("mean", F.col("sd").alias("std_dev"), F.col("least").alias("min"), F.col("greatest").alias("max")).alias("score_statistics"), F.col("leaders").alias("top_performers")))
    return rows.select("name", repo.alias("hf_repo"), _ids(repo), _metadata(F.col("name"), F.get("folders", F.lit(0)), F.col("source_type"), F.col("urls"), F.col("eval_library"), F.col("metrics"), summary, F.col("num_models"), "single", F.coalesce("appears_in", F.array().cast("array<string>")), F.lit(None)))


def suite_inputs(state: State, suites: DataFrame) -> DataFrame:
    """The same for suites: metrics of all members, distinct models, no summary."""
    members = suites.select("folder", F.posexplode("members").alias("nth", "name")).join(state.benchmarks.select("name", "bench", "metrics"), "name", "left")
    metrics = members.groupBy("folder").agg(_in_order(members, "metrics").alias("metrics"))
    models = members.join(state.scores.select("bench", "model"), "bench").groupBy("folder").agg(F.countDistinct("model").alias("num_models"))
    rows = suites.join(metrics, "folder", "left").join(models, "folder", "left")
    return rows.select(F.col("folder").alias("name"), F.lit(None).cast("string").alias("hf_repo"), _ids(F.lit(None)), _metadata(F.col("folder"), F.col("folder"), F.lit("url"), F.col("urls"), F.col("eval_library"), F.col("metrics"), F.lit(None), F.coalesce("num_models", F.lit(0)), "composite", F.array().cast("array<string>"), F.col("members")))


def manual_inputs(rows: DataFrame) -> DataFrame:
    """The same for benchmarks given by hand: (name, paper_url, hf_repo, appears_in), without metrics or scores."""
    none = F.array().cast("array<string>")
    ids = F.struct(F.col("hf_repo").alias("hf_repo"), F.col("paper_url").alias("paper_url"), F.lit(None).cast("array<string>").alias("risk_tags")).alias("extracted_ids")
    return rows.select("name", "hf_repo", ids, _metadata(F.col("name"), F.lit(None), F.lit("manual"), none, F.lit(None), none, F.lit(None), F.lit(0), "single", F.coalesce("appears_in", none), F.lit(None)))


_SUMMARY = "struct<total_models_evaluated:bigint,primary_metric:string,score_statistics:struct<mean:double,std_dev:double,min:double,max:double>,top_performers:array<struct<rank:int,model:string,score:double>>>"


def _ids(repo: Column) -> Column:
    return F.struct(repo.cast("string").alias("hf_repo"), F.lit(None).cast("string").alias("paper_url"), F.lit(None).cast("array<string>").alias("risk_tags")).alias("extracted_ids")


def _metadata(name: Column, folder: Column, source: Column, urls: Column, library: Column, metrics: Column, summary: Column, models: Column, kind: str, appears_in: Column, contains: Column) -> Column:
    return F.struct(
        name.alias("benchmark_name"), folder.cast("string").alias("source_folder"), source.alias("source_type"), urls.alias("source_urls"), library.cast("string").alias("eval_library"), metrics.alias("metrics"),
        summary.cast(_SUMMARY).alias("evaluation_summary"), models.cast("long").alias("num_models_evaluated"), F.lit(kind).alias("benchmark_type"), appears_in.alias("appears_in"), contains.cast("array<string>").alias("contains"),
    ).alias("metadata")
