"""Operators for training-data pipelines: licences, archives, models, near copies, mixing, pieces."""
