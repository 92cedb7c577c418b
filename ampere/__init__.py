"""ampere — electricity-market time-series analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
public DataFrame API, generic in its column names; the energy tables are the
default configuration (see :mod:`ampere.config`).
"""

__version__ = "0.1.0"
