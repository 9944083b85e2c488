"""Trip analytics on Spark: every operator is a ``DataFrame -> DataFrame`` function."""

from tripstats.model import COMPAT, FLEETS, GREEN, TYPED, YELLOW, Fleet

__all__ = ["COMPAT", "FLEETS", "GREEN", "TYPED", "YELLOW", "Fleet"]
