"""Composed jobs over whole input folders and layers."""
