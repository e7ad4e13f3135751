"""acqlens: portfolio analytics (income statements, occupancy, lender ledgers,
acquisition lists) as Spark DataFrame transformations.

Every public operator is a pure ``DataFrame -> DataFrame`` function built from
Column expressions, joins and aggregates; there are no Python UDFs.
"""

__all__ = ["session"]
