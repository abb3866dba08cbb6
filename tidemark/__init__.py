"""tidemark: keep lakehouse tables in step with a source system, on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function. Only the
modules under ``tidemark.sinks`` and ``tidemark.streaming`` write data.
"""

__version__ = "0.1.0"
