"""What counts as a missing value. Sources use several sets of stand-in strings; each has a name here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import Text, col
from .names import strip

# The stand-ins for "missing" by where they are used.
SENTINELS = {
    "card": ("not specified", "not specified.", "no information found", "no information found."),
    "override": ("not specified", "not specified.", "no information found", ""),
    "atom": ("not specified", "no information found", ""),
    "baseline": ("not specified", ""),
}
NOT_SPECIFIED = "Not specified"


def is_missing(x: Text, kind: str = "card") -> Column:
    """Whether a string is a stand-in, whatever white space is around it. Null is no stand-in."""
    return F.coalesce(F.lower(strip(col(x))).isin(*SENTINELS[kind]), F.lit(False))


def is_missing_list(x: Text, kind: str = "card") -> Column:
    """Whether a list is null, empty, or has a stand-in as its one entry."""
    v = col(x)
    return v.isNull() | (F.size(v) == 0) | ((F.size(v) == 1) & is_missing(F.get(v, F.lit(0)), kind))


def normalized(x: Text) -> Column:
    """The value, or the one spelling of the stand-in if there is none."""
    return F.when(col(x).isNull() | is_missing(x), F.lit(NOT_SPECIFIED)).otherwise(col(x))
