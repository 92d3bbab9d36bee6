from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Text = Column | str


def col(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x
