"""gatehouse: screen, assemble and judge text submissions at scale on Spark.

Every operator is a DataFrame transformation (built-in functions, joins,
aggregates, windows, Structured Streaming); nothing is collected to the
driver. See README.md for the operator inventory.
"""

from gatehouse.session import build_session, ensure_semantics, shared_dir

__all__ = ["build_session", "ensure_semantics", "shared_dir"]
