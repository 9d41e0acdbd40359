"""pointgate: a time-series quality gate built on PySpark DataFrames."""

from pointgate.options import (
    Bound,
    GateOptions,
    LimitOptions,
    OutputOptions,
    PathMapping,
    PointMapping,
)

__all__ = [
    "Bound",
    "GateOptions",
    "LimitOptions",
    "OutputOptions",
    "PathMapping",
    "PointMapping",
]
