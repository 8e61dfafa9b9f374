"""navedge: clickstream edge analytics on Spark.

Edges ``(prev, curr, type, n)`` are read from separated files, text or JSON
messages and message streams; the questions in ``navedge.plans.questions``
are DataFrame functions of an edge table and run unchanged in batch and, via
``navedge.streaming``, on streams.
"""

__version__ = "0.1.0"
