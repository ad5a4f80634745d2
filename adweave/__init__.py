"""Marketing measurement on Spark: attribution, identity, mix, calibration, uplift and model operations."""

__version__ = "0.1.0"
