"""Reading and writing of extracts and tables."""
