"""Whole reports: operators wired together for one moment or date range."""
