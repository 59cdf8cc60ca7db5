"""Fixed values of the method: limits, sizes and rules for what may be shown."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MIN_PEOPLE_FOR_RANGES = 20
MIN_ITEMS_FOR_FULL = 60
ALPHA_VERIFIED = 0.8
ALPHA_TENTATIVE = 0.667
MEASUREMENT_SIZE = 150
PERSON_CAP = 5
THREAD_CAP_PCT = 10
DETAIL_BUDGET = 200
DETAIL_PER_PERSON = 5
MIN_WORDS = 8
BOOT_DRAWS = 5000
MIN_MENTIONS = 3
MIN_PER_SIDE = 15
TOP_STANCE, TOP_PERIOD, TOP_SHIFTS = 6, 5, 8
LARGEST_THREADS = 5
LEAN_FOR, LEAN_AGAINST = 80.0, 20.0


def result_status(people: Column, items: Column) -> Column:
    """Fewer than 20 people: counts only; fewer than 60 items: an early signal."""
    return (
        F.when(people < MIN_PEOPLE_FOR_RANGES, "counts-only").when(items < MIN_ITEMS_FOR_FULL, "early-signal").otherwise("full")
    )


def agreement_status(alpha: Column) -> Column:
    return (
        F.when(alpha.isNull(), "unverified")
        .when(alpha >= ALPHA_VERIFIED, "verified")
        .when(alpha >= ALPHA_TENTATIVE, "tentative")
        .otherwise("unreliable")
    )


def pct(k: Column, n: Column) -> Column:
    """Percentage, null without a base. Display rounding is left to the caller."""
    return F.when(n > 0, 100.0 * k / n)
