"""Driver-facing queries built from the library operators."""

from .registry import ORACLES, QUERIES  # noqa: F401
from . import core, fishq, habitatq, ioq, reportq, sites, spatialq, summaries, timeq, toolsq  # noqa: F401  (registers queries)
