"""tidewell: refining raw tables into clean ones on Spark, in batch and on streams."""

__version__ = "0.1.0"
