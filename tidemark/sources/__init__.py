"""Typed tables in, tables and reports out."""
