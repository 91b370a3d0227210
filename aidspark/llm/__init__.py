"""Operators of a training-data pipeline (scoring, filtering, deduplication,
decontamination, packing). Nothing else in the library imports this package."""
