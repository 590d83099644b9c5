"""Sources and sinks: whole-file artifact scan (S1), request and verdict sinks
(S3, S4); files read and written by the paths a table names."""

from gatehouse.sources.artifacts import read_artifacts
from gatehouse.sources.named import file_status, read_named, write_named
from gatehouse.sources.sinks import write_artifacts, write_requests, write_verdicts

__all__ = ["read_artifacts", "file_status", "read_named", "write_named", "write_artifacts", "write_requests", "write_verdicts"]
