"""Relational operators: structural gate, semantic rules, batch checks, resolution, load."""
