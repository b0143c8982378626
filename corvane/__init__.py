"""Corvane: conversation-corpus analytics and training-data preparation as plain Spark jobs."""
