"""Jobs: operators composed into the tables people ask for."""
