"""SQL expression builders: statistics from power sums, and null-safe ratios.

Operators with many aggregates state them as SQL text and parse them in one call, which
keeps the driver's share of a wide plan small.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def aggregate(df: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """``df`` grouped by ``keys``, with the given SQL aggregates (``"sum(n) AS rows"``)."""
    keys = ", ".join(keys)
    return df.sparkSession.sql(f"SELECT {keys}, {', '.join(columns)} FROM {{df}} GROUP BY {keys}", df=df)


def ratio(a: str, b: str) -> str:
    """``a / b`` as double; NULL when either side is NULL or ``b`` is 0."""
    return f"double({a}) / nullif(double({b}), 0d)"


def sample_skewness(n: str, s1: str, s2: str, s3: str) -> str:
    """Bias-corrected sample skewness of whole numbers from their count and the sums of x, x^2 and x^3.

    NULL below three values, 0.0 for a constant group. The sums are first shifted, as whole
    numbers and so without loss, to x - k for the k next to the mean: what is left of the
    mean is at most a half, and nothing cancels, however many equal values there are.
    """
    k = f"(({s1} + IF({s1} < 0, -{n}, {n}) div 2) div {n})"  # rounds without leaving whole numbers, which is far cheaper
    c1 = f"({s1} - {n} * {k})"
    c2 = f"({s2} - 2 * {k} * {s1} + {n} * {k} * {k})"
    c3 = f"({s3} - 3 * {k} * {s2} + 3 * {k} * {k} * {s1} - {n} * {k} * {k} * {k})"
    d, m1, m2, m3 = f"double({n})", *(f"(double({c}) / double({n}))" for c in (c1, c2, c3))
    return (
        f"CASE WHEN {n} < 3 THEN NULL WHEN {m2} <= {m1} * {m1} THEN 0d "
        f"ELSE sqrt({d} * ({d} - 1)) / ({d} - 2) * ({m3} - 3 * {m1} * {m2} + 2 * pow({m1}, 3)) "
        f"/ pow({m2} - {m1} * {m1}, 1.5) END"
    )


def sample_stddev(n: str, s1: str, s2: str) -> str:
    """Standard deviation with n - 1 in the divisor; NULL for a single value."""
    n, s1, s2 = (f"double({c})" for c in (n, s1, s2))
    return f"CASE WHEN {n} > 1 THEN sqrt(greatest({s2} - {s1} * {s1} / {n}, 0d) / ({n} - 1)) END"
