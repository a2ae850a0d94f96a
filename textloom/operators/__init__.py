"""DataFrame transformations: selection, ranking, mixing, vocabulary, scoring, reports."""
