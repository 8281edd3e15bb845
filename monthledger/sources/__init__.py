"""Source schemas, readers with edge casts, result writers and test fixtures."""
