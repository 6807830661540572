"""regstar: a Spark-native claims star schema.

Sources are read with ``spark.read`` (JDBC, delimited files, Parquet); keys are
cleaned and codes recoded with built-in column expressions; dimensions, facts
and the business questions are DataFrame plans that Catalyst optimises. No
Python row functions run anywhere in the library.

Layout:

- ``regstar.sources``    readers, fixed schemas, adapter from the driver tables
- ``regstar.functions``  column expressions (key cleaning, price parsing, keys)
- ``regstar.operators``  reusable plan fragments (lookups, arg-max, shares,
                         recoding, data-quality checks)
- ``regstar.plans``      calendar, dimensions, facts, questions, SQL forms
- ``regstar.streaming``  intentionally empty (the modelled program has no stream)
"""

__version__ = "0.1.0"
