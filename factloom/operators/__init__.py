"""Operators that make, correct and relate rows."""
