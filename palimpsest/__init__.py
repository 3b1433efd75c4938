"""Palimpsest: a Spark-native engine for versioned text records.

Subpackages: ``operators`` (relational and custom operators), ``functions``
(column expressions and Arrow functions), ``sources`` (readers and sinks),
``streaming`` (Structured Streaming twins), ``plans`` (the registered queries
and their SQL oracles) and ``llm`` (training-data text operators; optional,
nothing else imports it).
"""

__version__ = "0.1.0"
