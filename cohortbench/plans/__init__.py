"""Whole computations: the yearly survey pipeline and the order-book universe."""
