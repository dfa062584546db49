"""mise: Spark-native extraction, loading and search over semi-structured dish data.

Every operator is a function from DataFrame(s) to a DataFrame built from the public
DataFrame / SQL / Structured Streaming API.  Sub-packages:

``sources``    reading raw CSV, staging records, run outcomes (A1-A17)
``functions``  column expressions that turn text into structure (B1-B31) and analyse text (S1)
``operators``  load/merge (L), relational (R), search (S) and aggregation (G) operators
``plans``      bindings of the operators to concrete tables and the registered queries
``streaming``  incremental loading with Structured Streaming (T1-T5)
"""

__version__ = "0.1.0"
