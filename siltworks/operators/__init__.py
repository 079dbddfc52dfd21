"""Session features, the filter cascade, deduplication, pooling and delivery."""
