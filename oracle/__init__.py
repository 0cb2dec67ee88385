"""DuckDB statements that state the expected result of every registered query.

They follow the rules directly, row by row and without any of the Spark plans'
rearrangements, so that agreement means something.
"""
