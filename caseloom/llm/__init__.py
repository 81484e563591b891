"""Operators of a training-data pipeline: documents, pages and vectors in, decisions and packed sequences out."""
