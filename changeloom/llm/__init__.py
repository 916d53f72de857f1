"""Operators for preparing training data: counting, matching, searching, filtering and mixing documents."""
