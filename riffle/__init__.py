"""riffle — field-survey and asset-inspection records to decision tables, on Spark."""

__version__ = "0.1.0"
