"""Trustworthy hourly and daily analytics over nested sensor documents, on Spark."""
