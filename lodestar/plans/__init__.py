"""End-to-end flows per record type, composed from the operators.

Each flow is a function of DataFrames (landed payloads, sink tables,
dimensions) returning DataFrames; nothing is collected and every stage is a
Spark plan.  Shuffles per flow are listed in each docstring.
"""
