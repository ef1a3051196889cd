"""Analytics for metered solar energy on Spark DataFrames."""

from sunledger.tables import Tables

__all__ = ["Tables"]
