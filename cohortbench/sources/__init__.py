"""Reading yearly delimited files and finished marts."""
