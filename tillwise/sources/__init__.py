"""Reading, landing and materializing tables."""
