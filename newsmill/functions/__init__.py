"""Column expressions and fixed vocabulary: text matching, scoring, URLs and HTML."""
