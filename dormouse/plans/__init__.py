"""Whole queries: tables and an instant in, a result table out."""
