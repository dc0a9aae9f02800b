"""Text-corpus and retrieval jobs expressed as Spark DataFrame transformations."""
