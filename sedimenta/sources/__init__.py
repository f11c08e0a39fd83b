"""Landed inputs, shaped into raw records."""
