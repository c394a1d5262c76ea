"""Training-data operators over documents, pages and embeddings."""
