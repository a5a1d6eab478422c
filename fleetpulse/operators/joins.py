"""Joins against a side that is expected, but not known, to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.session import cut_lineage
from fleetpulse.settings import MAX_BROADCAST_ROWS


def join_checked(
    big: DataFrame, small: DataFrame, on: list[str], how: str, bound: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``small`` when a count shows it to fit the bound, else shuffle both sides.

    ``small`` is computed once, into the shared folder. In the shuffled join a hot key is
    split by adaptive skew handling, which works for the inner, left and semi joins used here.
    """
    side = cut_lineage(small)
    return big.join(F.broadcast(side) if side.count() <= bound else side, on, how)
