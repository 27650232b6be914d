"""Model plans: view layers, operational tables, reports, analyses, checks."""

from .pipeline import OPS_TABLES, REPORT_TABLES, Pipeline

__all__ = ["OPS_TABLES", "REPORT_TABLES", "Pipeline"]
