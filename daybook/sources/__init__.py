"""Reading exports and writing results."""
