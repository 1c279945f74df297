"""Independent DuckDB statements for every registered query.

The statements share nothing with the Spark code: they work on scaled integers (cents, hundredths of
a percent) and round with integer division, so both engines must reach the same exact values.
"""
