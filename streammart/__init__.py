"""streammart: DataFrame operators for a real-time commerce warehouse.

Layers:
  functions  column expressions (JSON, time, keys, words)
  sources    topics, change logs, dimension tables, sinks
  operators  filters, routing, joins, keyed flags, tumbling windows
  streaming  StatefulProcessor forms of the keyed operators
  plans      fact tables, summary tables, dashboard queries, stream jobs
"""
