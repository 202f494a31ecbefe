"""Whole jobs: sources, operators, checks and sinks put together."""
