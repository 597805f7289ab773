"""Relational steps between the raw families and the marts."""
