"""DataFrame operators: scale helpers, terms, weights, vectors, clustering."""
