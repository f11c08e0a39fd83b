"""Layers: raw records to bronze, bronze to silver, silver to gold."""
