"""Data checks: each returns its failing rows, empty means pass."""
