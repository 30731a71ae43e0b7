"""Declarative family specs and their compositions."""
