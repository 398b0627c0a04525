"""Whole jobs: operators put together, from a task to its five result tables."""
