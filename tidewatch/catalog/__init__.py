from tidewatch.catalog import combining, drawing, files, panels, streams, tagging, vectors  # noqa: F401
from tidewatch.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
