"""From a folder of evaluation files to benchmarks, suites and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalize_name
from ..operators import evaluations as E
from ..operators import resolve, suites
from ..sources import evaluations as S
from ..storage import materialise


@dataclass
class Evaluations:
    """benchmarks and scores after merging; suites (folder, bench); composites (folder, members, urls, eval_library)."""

    benchmarks: DataFrame
    scores: DataFrame
    suites: DataFrame
    votes: DataFrame
    errors: DataFrame
    composites: DataFrame


def prepare(spark: SparkSession, root: str, max_files: int = 50, collapse: bool = True) -> Evaluations:
    """Scans root, averages subjects within benchmarks, then merges benchmarks by name and by folder, or keeps suites."""
    files = S.scan(spark, root, max_files)
    results, _ = materialise(S.results(files), "results")
    rows = S.scores(results)
    metadata, _ = materialise(S.folder_metadata(results), "folder-metadata")
    benchmarks, _ = materialise(E.roll_up(rows), "benchmarks")
    scores, _ = materialise(E.average_subjects(E.keyed(rows)), "scores")
    state = suites.name_subgroups(suites.State(benchmarks, scores), metadata)
    state, composites, votes = suites.folders(state, metadata, collapse)
    members = composites.select("folder", F.explode("members").alias("_name")).select("folder", normalize_name("_name").alias("bench"))
    return Evaluations(state.benchmarks, state.scores, members.join(state.benchmarks.select("bench"), "bench", "left_semi"), votes, S.errors(files), composites)


def inputs(spark: SparkSession, found: Evaluations) -> DataFrame:
    """What the card pipeline starts from, for benchmarks and suites."""
    state = suites.State(found.benchmarks, found.scores)
    own = suites.benchmark_inputs(state, found.composites, E.summary(found.scores), resolve.repository_overrides(spark))
    return own.unionByName(suites.suite_inputs(state, found.composites))
