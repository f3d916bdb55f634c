"""Reading logs and tables, and writing results."""
