"""Operators of a training-data pipeline: documents, embeddings, pages and conversations."""
