"""Primary-care analytics as lazy Spark DataFrame functions."""

from carespan.codes import CodeSets
from carespan.setting import Period, Setting, period_bounds

__all__ = ["CodeSets", "Period", "Setting", "period_bounds"]
