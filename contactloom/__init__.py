"""Contact and registry data engine: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
