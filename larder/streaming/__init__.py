"""Incremental loading of arriving files; all analysis is batch."""
