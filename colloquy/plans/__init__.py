"""End-to-end jobs: stored tables in, stored tables and report frames out."""
