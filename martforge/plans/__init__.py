"""Data products: dimensions, fact, lake month, marts, reports, pipeline."""
