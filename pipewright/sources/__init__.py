"""Sources: declared schemas, the driver-table adapter and readers."""

from . import adapter, schemas
from .tables import DRIVER_TABLES, Sources, as_text_timestamps, read_driver

__all__ = ["adapter", "schemas", "DRIVER_TABLES", "Sources", "as_text_timestamps", "read_driver"]
