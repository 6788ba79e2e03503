"""touchline: marketing-event processing as plain Spark jobs.

Every operator is a ``DataFrame -> DataFrame`` function.  Sources produce
Kafka-shaped rows, operators decode, deduplicate, rank, attribute and count
them, and sinks write them so that a replayed micro-batch changes nothing.
"""

__version__ = "0.1.0"
