"""Training-data operators on Spark.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames and has its own module; ``queries.py`` binds them to the
given tables and ``oracle.py`` states the results in DuckDB SQL where SQL can.
"""
