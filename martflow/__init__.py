"""martflow -- a real-time retail warehouse on Spark DataFrames.

Layers: ``sources`` (feeds and derived inputs), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``streaming``
(Structured Streaming adapters and sinks) and ``plans`` (registered queries
and their SQL twins).
"""

__version__ = "0.1.0"
