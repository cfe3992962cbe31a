"""Training-data operators on documents, pages, embeddings and benchmarks. Nothing else in the library imports this subpackage."""
