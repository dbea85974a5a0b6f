"""kestrel: company-signal pipelines written as Spark DataFrame and Structured Streaming jobs.

Layout:
  sources/    landed payloads -> typed entity frames, table reads
  functions/  column-level helpers (defaults, keys, envelopes)
  operators/  relational building blocks (rollups, newest-N, upserts, data quality, rankings, signals)
  sinks/      layered lake tables, topic envelopes, optional warehouse and JDBC sinks
  streaming/  stream specs, payload parsing, windowed and stateful stream jobs
  plans/      end-to-end jobs and the query registry bound to the shared test tables
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
