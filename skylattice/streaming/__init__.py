"""Streaming forms of the aggregates that need no look ahead."""
