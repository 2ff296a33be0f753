"""skyroute: flight on-time analytics as Spark DataFrame operators.

Layout:
  functions/  column-level expressions (parsing, time handling)
  sources/    CSV, archives, message chunks, stream sources, published tables
  operators/  reusable DataFrame operators (aggregates, ranking, joins)
  plans/      the analytic questions composed from operators
  streaming/  Structured Streaming forms of the same questions
"""

__version__ = "0.1.0"
