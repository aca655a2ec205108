"""cdcflow: change-data sync and record ETL as PySpark DataFrame operators."""

__version__ = "0.1.0"
