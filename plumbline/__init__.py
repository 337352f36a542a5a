"""Table quality on Spark: profile, check, repair and score any DataFrame."""

from plumbline.config import Thresholds

__all__ = ["Thresholds"]
