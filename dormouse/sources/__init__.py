"""Reading the account tables and writing results."""
