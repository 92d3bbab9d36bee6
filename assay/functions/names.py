"""Names, slugs and keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Text, col


def strip(x: Text) -> Column:
    """Without white space at both ends, whatever kind it is."""
    return F.regexp_replace(col(x), r"^\s+|\s+$", "")


def normalize_name(x: Text) -> Column:
    """The key under which spellings of a benchmark name meet: trimmed, lower case, `_` and blanks as `-`."""
    return F.translate(F.lower(strip(x)), "_ ", "--")


def underscore_name(x: Text) -> Column:
    """The other spelling of keys: `-` and blanks as `_`."""
    return F.translate(F.lower(strip(x)), "- ", "__")


def slug(x: Text) -> Column:
    """Lower case, every run outside [a-z0-9.] one `-`, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(col(x)), "[^a-z0-9.]+", "-"), "^-+|-+$", "")


def output_key(canonical_id: Text, name: Text) -> Column:
    """The canonical id if there is one, else the slug."""
    known = col(canonical_id)
    return F.when(known.isNotNull() & (known != ""), known).otherwise(slug(name))


def sub_label(sub: Text, parent: Text) -> Column:
    """What a sub-benchmark's name adds to its parent's, in words; the whole name if it does not begin with it."""
    whole, head = normalize_name(sub), normalize_name(parent)
    rest = F.substring(whole, F.length(head) + 1, F.length(whole))
    cut = F.regexp_replace(F.when(whole.startswith(head) & (F.length(head) > 0), rest).otherwise(whole), "^-+|-+$", "")
    return F.translate(F.when(cut == "", whole).otherwise(cut), "-", " ")


def title_case(x: Text) -> Column:
    """Every run of letters with a capital first letter; initcap() would only look at blanks."""
    parts = F.regexp_extract_all(F.lower(col(x)), F.lit(r"([a-zà-ÿ]+|[^a-zà-ÿ]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def common_prefix(least: Text, greatest: Text) -> Column:
    """The longest common prefix of a set of strings from its least and greatest member."""
    a, b = col(least), col(greatest)
    lengths = F.filter(F.sequence(F.lit(0), F.least(F.length(a), F.length(b))), lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n))
    return F.substring(a, F.lit(1), F.array_max(lengths))


def suite_name(folder: Text, least: Text, greatest: Text) -> Column:
    """The name of a collapsed suite: the members' common prefix if it has 4 characters, else the folder without its harness."""
    prefix = F.regexp_replace(common_prefix(least, greatest), "[- ]+$", "")
    bare = F.regexp_replace(col(folder), "^(helm_|hf_|hfopenllm_)", "")
    return title_case(F.when(F.length(prefix) >= 4, F.translate(prefix, "-", " ")).otherwise(F.translate(bare, "_-", "  ")))


def one_decimal(x: Column) -> Column:
    """A double with one decimal as C prints it: its exact binary value rounded, ties to even. Java's format rounds the digits it prints.

    Below 2^53 all steps are exact: the fraction is counted in units of 2^-57; what that cuts off lies far from a tie.
    """
    unit = 1 << 57
    size = F.abs(x)
    whole = F.floor(size)
    tenfold = ((size - whole) * float(unit)).cast("long") * 10
    tenth, rest = F.shiftright(tenfold, 57), tenfold.bitwiseAND(F.lit(unit - 1))
    up = (rest > unit // 2) | ((rest == unit // 2) & (tenth % 2 == 1))
    tenth = tenth + up.cast("long")
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    exact = F.format_string("%s%d.%d", sign, whole + F.floor(tenth / 10), tenth % 10)
    return F.when(size < float(1 << 53), exact).otherwise(F.format_string("%.1f", x))


def duration(seconds: Text) -> Column:
    """Seconds, minutes or hours with one or no decimal; null for none."""
    s = col(seconds).cast("double")
    whole = F.floor(s)
    return (
        F.when(s < 60, F.concat(one_decimal(s), F.lit("s")))
        .when(s < 3600, F.format_string("%dm %ds", F.floor(whole / 60), whole % 60))
        .when(s.isNotNull(), F.format_string("%dh %dm", F.floor(whole / 3600), F.floor((whole % 3600) / 60)))
    )
