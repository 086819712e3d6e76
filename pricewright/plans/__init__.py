"""Whole jobs: the linear price model, the model comparison, the query list."""
