"""Threshold labels. Where a null has no branch of its own it takes the last one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gap thresholds and labels.
GAP_LARGE = "Large Gap (10%+)"
GAP_MODERATE = "Moderate Gap (5-10%)"
GAP_SMALL = "Small Gap (<5%)"
GAP_NONE = "No Gap / Outperforming"
GAP_UNKNOWN = "Insufficient Data"

# Standing against the peer mean, in percentage points.
ABOVE_PEERS = "Above Peers"
BELOW_PEERS = "Below Peers"
AT_PEERS = "At Peer Average"
PEER_MARGIN = 5


def gap_severity(gap: Column) -> Column:
    return (
        F.when(gap.isNull(), GAP_UNKNOWN)
        .when(gap <= 0, GAP_NONE)
        .when(gap < 5, GAP_SMALL)
        .when(gap < 10, GAP_MODERATE)
        .otherwise(GAP_LARGE)
    )


def peer_standing(own: Column, peer_mean: Column, margin: float = PEER_MARGIN) -> Column:
    """A null on either side reads as at the peer average."""
    return (
        F.when(own >= peer_mean + margin, ABOVE_PEERS)
        .when(own <= peer_mean - margin, BELOW_PEERS)
        .otherwise(AT_PEERS)
    )


def at_least(value: Column, threshold: float) -> Column:
    """True at or above the threshold, false below it and for null."""
    return F.coalesce(value >= threshold, F.lit(False))


@dataclass(frozen=True)
class Tier:
    """A labelling with a known, finite set of labels."""

    name: str
    expr: Column
    labels: tuple

    def column(self) -> Column:
        return self.expr.alias(self.name)


def size_tier(name: str, size: Column, small_below: float, medium_below: float) -> Tier:
    """Null sizes fall through to Large."""
    expr = (
        F.when(size < small_below, "Small").when(size < medium_below, "Medium").otherwise("Large")
    )
    return Tier(name, expr, ("Small", "Medium", "Large"))


def two_way_tier(name: str, condition: Column, yes: str, no: str) -> Tier:
    """Null conditions take the second label."""
    return Tier(name, F.when(condition, yes).otherwise(no), (yes, no))


def flag_tier(name: str, value: Column, threshold: float) -> Tier:
    return Tier(name, at_least(value, threshold), (True, False))


def group_bound(tiers: list[Tier]) -> int:
    """Most groups the tiers can form together, however large the data."""
    bound = 1
    for tier in tiers:
        bound *= len(tier.labels)
    return bound
