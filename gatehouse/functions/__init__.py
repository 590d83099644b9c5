"""Column expressions: pure built-in Spark functions, codegen-friendly."""

from gatehouse.functions.text import (is_blank, normalise_newlines, placeholder_flags,
                                      rstrip_slash, strip)
from gatehouse.functions.urls import target_url, valid_base_url
from gatehouse.functions.verdict import classify, exit_code, parse_verdict

__all__ = [
    "strip", "rstrip_slash", "normalise_newlines", "is_blank", "placeholder_flags",
    "valid_base_url", "target_url", "parse_verdict", "classify", "exit_code",
]
