"""lorry: freight-operations report jobs on Spark DataFrames."""

from lorry.sources.tables import Tables

__all__ = ["Tables"]
