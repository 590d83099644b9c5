"""Structured Streaming operators."""

from gatehouse.streaming.judge_stream import judge_within_stream, read_verdicts, write_verdict_stream
from gatehouse.streaming.match_stream import MATCH_SCHEMA, match_within_stream

__all__ = ["match_within_stream", "MATCH_SCHEMA", "judge_within_stream", "write_verdict_stream", "read_verdicts"]
