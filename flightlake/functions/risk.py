"""Weather-risk scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk band thresholds and names.
BAND_HIGH, BAND_MID = 90.0, 75.0
BAND_NAMES = ("red", "orange", "white")
MISSING_SCORE = -1.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def percentile_of_score(n_less, n_less_equal, n_total) -> Column:
    """Percentile rank of a score ('rank' kind): ``(l + r + [l < r]) * 50 / n``.

    ``l`` counts history values below the score, ``r`` those at or below it.
    Null when ``n`` is zero (the caller maps that to the missing score).
    """
    lt, le, n = _c(n_less), _c(n_less_equal), _c(n_total)
    bump = F.when(lt < le, F.lit(1)).otherwise(F.lit(0))
    return F.when(n > 0, (lt + le + bump) * (F.lit(50.0) / n.cast("double")))


def risk_band(risk, high: float = BAND_HIGH, mid: float = BAND_MID) -> Column:
    """red at or above ``high``, orange at or above ``mid``, white otherwise."""
    r = _c(risk)
    return (F.when(r >= F.lit(high), F.lit(BAND_NAMES[0]))
            .when(r >= F.lit(mid), F.lit(BAND_NAMES[1]))
            .otherwise(F.lit(BAND_NAMES[2])))
