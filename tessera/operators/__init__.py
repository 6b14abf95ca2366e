"""Operators over article tables: profiling, validation, cleaning, splits, models, metrics."""
