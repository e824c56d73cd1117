"""DataFrame-in, DataFrame-out operators of the extraction and index engine."""
