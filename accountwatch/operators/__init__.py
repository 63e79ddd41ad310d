"""DataFrame-to-DataFrame operators: detection, state, keep-one, retrieval, figures."""
