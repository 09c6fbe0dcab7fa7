"""End-to-end jobs and the inputs derived from the benchmark tables."""
