"""Scans: delimited tag lines, stage tables, dictionaries and dense point tables."""
