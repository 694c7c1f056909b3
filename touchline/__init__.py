"""touchline: a PySpark library for match and event analytics.

Sub-packages: ``sources`` (readers, sinks, catalogs), ``functions`` (Column -> Column scalars),
``operators`` (DataFrame -> DataFrame operators), ``ml`` (Spark ML jobs), ``plans`` (queries bound
to the test tables and their SQL oracles), ``streaming`` (file-stream batch scoring).
"""

__version__ = "0.1.0"
