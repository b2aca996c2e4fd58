"""Entity schemas, scans and sinks."""

from . import schemas
from .documents import Documents, scan_documents
from .readers import load_table, scan, scan_delimited
from .writers import save_table, write_report

__all__ = ["Documents", "load_table", "save_table", "scan", "scan_delimited",
           "scan_documents", "schemas", "write_report"]
