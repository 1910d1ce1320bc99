"""tiermart: layered (bronze -> silver -> gold) batch analytics on Spark.

Every transform is a lazy ``DataFrame -> DataFrame`` function built from
built-in Spark expressions; I/O lives only in ``tiermart.sources`` and
``tiermart.streaming``.
"""

__version__ = "0.1.0"
