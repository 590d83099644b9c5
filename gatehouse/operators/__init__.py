"""Relational operators: joins, aggregates and windows over submission tables."""

from gatehouse.operators.bundle import (assemble_bundle, check_arity, first_failure,
                                        reconcile, request_json, resolve_paths,
                                        submission_headers)
from gatehouse.operators.kinds import artifact_kind
from gatehouse.operators.match import match_within
from gatehouse.operators.overlay import overlay, overlay_settings
from gatehouse.operators.screen import endpoint_available, screen

__all__ = [
    "overlay", "overlay_settings", "submission_headers", "check_arity", "resolve_paths", "reconcile",
    "first_failure", "assemble_bundle", "request_json", "artifact_kind",
    "endpoint_available", "screen", "match_within",
]
