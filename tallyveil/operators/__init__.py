"""Operators as functions from DataFrame to DataFrame, a module for each family."""
