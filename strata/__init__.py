"""strata: layered (bronze / silver / gold) refinement of coded statistical
time series on plain Apache Spark."""

__version__ = "0.1.0"
