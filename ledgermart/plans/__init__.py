"""Presets: the certificate mart wired from the generic operators, and its queries."""
