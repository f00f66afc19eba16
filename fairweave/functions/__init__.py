"""Column expressions over listings' texts, places and dates."""
