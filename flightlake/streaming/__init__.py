"""Structured Streaming refresh of the planner output."""
