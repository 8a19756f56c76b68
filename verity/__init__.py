"""verity: answer-evaluation analytics on Spark DataFrames and Structured Streaming.

The package is a set of functions over DataFrames and Columns:

* ``verity.sources``    schemas, table and file scans, stream sources and sinks
* ``verity.functions``  column expressions (text, prompts, answers, JSON, scalars)
* ``verity.operators``  scoring, decisions, reuse, upserts and analytics
* ``verity.plans``      the registered queries and their SQL oracles
* ``verity.streaming``  streaming scoring, stateful attempts and upserts
"""

__all__ = ["session"]
