"""Scalar functions, Column in and Column out."""
