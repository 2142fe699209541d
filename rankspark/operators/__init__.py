"""DataFrame operators: index, weighting, similarity, retrieval, evaluation."""
