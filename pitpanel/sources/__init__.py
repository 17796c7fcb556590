"""Reading, extracting, writing and verifying tables."""
