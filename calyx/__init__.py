"""calyx — period-oriented batch and streaming analytics on Spark.

Attempt-style records are normalised into typed tables, cut by calendar
periods, aggregated with conditional / distinct aggregates, written with
idempotent modes, checked, and exported.  Everything is expressed with the
DataFrame / SQL API so Catalyst plans it and Tungsten executes it.
"""

__version__ = "0.1.0"
