"""Joins, ordered scans and folds over whole tables."""
