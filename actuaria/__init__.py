"""actuaria — insurance-policy analytics on Spark DataFrames.

Layers: ``sources`` (landing CSV → bronze → silver, and the test-table
binding), ``plans`` (gold facts and the named query catalogue),
``operators`` (reusable profile / duplicate / check / score / segment
operators), ``functions`` (column rules), ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
