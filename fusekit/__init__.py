"""fusekit: a Spark-native multimodal feature fusion and classification library.

Subpackages: ``sources`` (readers), ``sinks`` (writers, model store),
``functions`` (column expressions), ``operators`` (DataFrame operators),
``plans`` (named queries, oracle SQL, the end-to-end chain) and
``streaming`` (Structured Streaming ingest and scoring).
"""

__version__ = "0.1.0"
