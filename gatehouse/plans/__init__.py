"""Fixture views, the three jobs (screen, assemble, judge) and the query catalog."""
