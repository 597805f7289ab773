"""Writing marts and exports."""
