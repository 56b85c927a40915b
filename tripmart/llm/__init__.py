"""Operators for training data: packing, counting, filtering, near copies, secrets, personal data."""
