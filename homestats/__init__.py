"""homestats — lazy Spark DataFrame operators for property-market data.

Every public operator takes a DataFrame (plus plain parameters) and returns a
DataFrame; nothing is collected unless an operator's output schema depends on
the data (documented where it happens).
"""

__version__ = "0.1.0"
