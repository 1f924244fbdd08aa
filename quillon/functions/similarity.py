"""String similarity."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf

ColumnOrName = Column | str


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, by one integer per row of the table (bit-parallel)."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """2 * LCS / (len a + len b); 1 for two empty strings."""
    n = len(a) + len(b)
    return 2 * lcs_length(a, b) / n if n else 1.0


def name_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """indel_ratio of two columns, in Arrow batches; null if either is."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([np.nan if p is None or q is None else indel_ratio(p, q) for p, q in zip(x, y, strict=True)]).astype("float64")

    return pandas_udf(run, "double")(a, b)
