"""tidings: newsletter digests as Spark jobs.

Messages are rows, message parts are an array column, token windows are an
array of structs, the summary fold is an ``aggregate`` or a round-batched
``mapInPandas`` pass, and read state is an append-only ledger table joined
with ``left_anti``.
"""

__version__ = "0.1.0"
