"""Sinks: layered lake tables, topic envelopes, optional warehouse and JDBC stores."""
