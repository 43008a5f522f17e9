"""tracelens: cluster job/task lifecycle analytics on Apache Spark.

Batch operators live in ``tracelens.operators``, sources in
``tracelens.sources``, wire formats and time helpers in
``tracelens.functions``, Structured Streaming forms in
``tracelens.streaming`` and the driver's queries with their SQL oracles in
``tracelens.plans``.
"""

__version__ = "0.1.0"
