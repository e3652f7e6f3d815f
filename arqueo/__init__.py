"""arqueo: reconciliation, netting and period reports of accounting systems on Spark."""

__version__ = "0.1.0"
