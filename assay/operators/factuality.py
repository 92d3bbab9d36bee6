"""Factuality of a card's fields from the probabilities of its atoms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMITS = (0.8, 0.6, 0.4, 0.2)
LABELS = ("HIGH_CONFIDENCE_CORRECT", "LIKELY_CORRECT", "UNCERTAIN", "LIKELY_INCORRECT", "HIGH_CONFIDENCE_INCORRECT")
NEUTRAL = 0.5


def label(p: str | Column = "p_true") -> Column:
    """One of five confidence labels; NO_SCORE for null. 0.4 is uncertain, 0.2 likely incorrect, 0.6 and 0.8 fall below."""
    x = F.col(p) if isinstance(p, str) else p
    return F.when(x.isNull(), "NO_SCORE").when(x > LIMITS[0], LABELS[0]).when(x > LIMITS[1], LABELS[1]).when(x >= LIMITS[2], LABELS[2]).when(x >= LIMITS[3], LABELS[3]).otherwise(LABELS[4])


def latest(marginals: DataFrame, ord_: str = "ord") -> DataFrame:
    """One marginal for each variable: at the place of the first of equals, with the value of the last."""
    return marginals.groupBy("variable").agg(F.max_by("p_true", ord_).alias("p_true"), F.min(ord_).alias("ord"))


#: Length of the grams that patterns are filed under.
GRAM = 3


def _grams(x: str, size: int) -> Column:
    """The different substrings of one length; none of shorter texts."""
    n = F.char_length(x)
    return F.when(n >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.substr(F.col(x), i, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def first_containing(patterns: DataFrame, variables: DataFrame) -> DataFrame:
    """(pattern, found): of variables (variable, ord, p_true) the first, by ord, that contains a pattern, as (ord, p_true).

    Variables are cut into grams, and patterns meet them in equi-joins: a pattern of at most GRAM characters is a gram itself; a
    longer one is filed under that of its grams which fewest variables have, and compared with those only.
    """
    value = F.struct("ord", "p_true").alias("found")
    known = variables.where("variable IS NOT NULL")
    asked = patterns.where("pattern IS NOT NULL").select("pattern").distinct()
    empty = asked.where("pattern = ''").crossJoin(known.agg(F.min(value).alias("found")))
    short = known.select("ord", "p_true", F.explode(F.flatten(F.array(*[_grams("variable", k) for k in range(1, GRAM + 1)]))).alias("pattern"))
    short = short.join(asked, "pattern", "left_semi").groupBy("pattern").agg(F.min(value).alias("found"))
    filed = known.select("variable", "ord", "p_true", F.explode(_grams("variable", GRAM)).alias("gram"))
    parts = asked.where(F.char_length("pattern") > GRAM).select("pattern", F.explode(_grams("pattern", GRAM)).alias("gram"))
    counts = filed.join(parts.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = parts.join(counts, "gram", "left").groupBy("pattern").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    long = filed.join(rarest, "gram").where(F.contains("variable", "pattern")).groupBy("pattern").agg(F.min(value).alias("found"))
    return empty.where("found IS NOT NULL").unionByName(short).unionByName(long)


def match(atoms: DataFrame, marginals: DataFrame, mode: str = "exact", head: int = 50) -> DataFrame:
    """Atoms (atom_id, text, field) with their p_true, one row for each of theirs.

    "exact" joins on variable = atom_id. "compat" takes the first variable, by ord, that contains the id or the first `head`
    characters of the text; without text that is the first of all.
    """
    single = latest(marginals)
    if mode == "exact":
        return atoms.join(single.select(F.col("variable").alias("atom_id"), "p_true"), "atom_id", "left")
    begin = F.substring(F.coalesce("text", F.lit("")), 1, head)
    asked = atoms.select(F.col("atom_id").alias("_id"), begin.alias("_begin")).distinct()
    found = first_containing(asked.select(F.explode(F.array("_id", "_begin")).alias("pattern")), single)
    each = asked.select("_id", "_begin", F.explode(F.array_distinct(F.array("_id", "_begin"))).alias("pattern"))
    best = each.join(found, "pattern").groupBy("_id", "_begin").agg(F.min("found")["p_true"].alias("p_true"))
    return atoms.join(best, F.col("atom_id").eqNullSafe(F.col("_id")) & (begin == F.col("_begin")), "left").drop("_id", "_begin")


def by_field(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts in five classes, the mean without neutral values, and percentages of right and wrong atoms for each field."""
    keys = keys or ["field"]
    p = F.col("p_true")
    classes = [F.count_if(label() == name).alias(name.lower()) for name in LABELS]
    out = scored.where(p.isNotNull()).groupBy(*keys).agg(F.count("*").alias("total_atoms"), *classes, F.count_if(p == NEUTRAL).alias("neutral_count"), F.avg(F.when(p != NEUTRAL, p)).alias("_mean"))
    right, wrong = F.col(LABELS[0].lower()) + F.col(LABELS[1].lower()), F.col(LABELS[3].lower()) + F.col(LABELS[4].lower())
    return (
        out.withColumn("all_neutral", F.col("_mean").isNull())
        .withColumn("avg_probability", F.coalesce("_mean", F.lit(NEUTRAL)))
        .withColumn("accuracy_percentage", right / F.col("total_atoms") * 100)
        .withColumn("error_percentage", wrong / F.col("total_atoms") * 100)
        .drop("_mean")
    )


def extremes(fields: DataFrame, ord_: str = "field") -> DataFrame:
    """The fields with the highest and the lowest accuracy, the first of equals, and how many have errors."""
    best = F.min_by("field", F.struct(-F.col("accuracy_percentage"), F.col(ord_)))
    worst = F.min_by("field", F.struct(F.col("accuracy_percentage"), F.col(ord_)))
    return fields.agg(F.count("*").alias("total_fields"), F.count_if(F.col("error_percentage") > 0).alias("fields_with_errors"), best.alias("most_accurate_field"), worst.alias("most_problematic_field"))


def entropy(scored: DataFrame, keys: list[str] | None = None, least: float = 1e-7) -> DataFrame:
    """Sum of binary entropies (base 10), its mean, and that mean over log10 n."""
    p = F.greatest(F.lit(least), F.least(F.lit(1 - least), F.col("p_true")))
    total, n = F.sum(-p * F.log10(p) - (1 - p) * F.log10(1 - p)), F.count("p_true")
    return scored.where("p_true IS NOT NULL").groupBy(*(keys or [])).agg(n.alias("n"), total.alias("entropy"), (total / n).alias("mean_entropy"), F.when(n > 1, total / n / F.log10(n)).otherwise(F.lit(0.0)).alias("scaled_entropy"))


def flags(fields: DataFrame, provenance: DataFrame | None = None, threshold: float = 0.8, keys: list[str] | None = None) -> DataFrame:
    """(keys, field, reason, message) of the fields to flag; names, and fields with source and evidence, are not flagged."""
    bad = fields.where(((F.col("avg_probability") < threshold) | F.col("all_neutral")) & ~F.col("field").endswith(".name"))
    if provenance is not None:
        proven = provenance.where("coalesce(source, '') <> '' AND coalesce(evidence, '') <> ''").select(*(keys or []), "field").distinct()
        bad = bad.join(proven, [*(keys or []), "field"], "left_anti")
    low = F.format_string("[Factuality Score: %.2f], low factual alignment with source material", F.col("avg_probability"))
    none = "[Possible Hallucination], no supporting evidence found in source material"
    return bad.select(*(keys or []), "field", F.when(F.col("all_neutral"), "all_atoms_neutral").otherwise("low_factuality_score").alias("reason"), F.when(F.col("all_neutral"), none).otherwise(low).alias("message"))


# Fields that validation by text inference cannot judge.
IDENTITY_FIELDS = ("benchmark_details.overview", "benchmark_details.domains", "benchmark_details.data_type", "benchmark_details.similar_benchmarks", "purpose_and_intended_users.goal", "purpose_and_intended_users.audience", "purpose_and_intended_users.tasks")
ANALYTICAL_FIELDS = ("purpose_and_intended_users.limitations", "purpose_and_intended_users.out_of_scope_uses", "methodology.interpretation")


def unflagged(found: DataFrame, overridden: DataFrame | None = None) -> DataFrame:
    """Flags without those on analytical fields, neutral ones on identity fields, and those on overridden fields."""
    left = found.where(~F.col("field").isin(*ANALYTICAL_FIELDS) & ~(F.col("field").isin(*IDENTITY_FIELDS) & (F.col("reason") == "all_atoms_neutral")))
    return left if overridden is None else left.join(overridden.select("field").distinct(), "field", "left_anti")


def atom_summary(scored: DataFrame) -> DataFrame:
    """Atoms with labels, lowest first, those without a score before all."""
    return scored.select("atom_id", "field", "p_true", label().alias("label")).orderBy(F.col("p_true").asc_nulls_first(), "atom_id")
