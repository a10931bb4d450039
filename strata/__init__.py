"""strata: layered (bronze / silver / gold) data-quality jobs on PySpark.

Everything is expressed as lazy DataFrame plans built from
``pyspark.sql.functions``; no Python UDFs are used in the hot path.
"""

__version__ = "0.1.0"
