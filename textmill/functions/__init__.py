"""Scalar functions: Column to Column."""
