"""Whole jobs: from a log to the tables of a report."""
