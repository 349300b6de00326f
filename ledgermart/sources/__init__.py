"""Readers for landed files: batch CSV, file routing, ad-hoc CSV and JSON."""
