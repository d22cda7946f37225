"""Corpus operators for training-data pipelines: filtering, counting, linking, dedup, mixing."""
