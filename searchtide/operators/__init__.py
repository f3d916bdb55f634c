"""Counts, rankings, comparisons, profiles and classification of keywords."""
