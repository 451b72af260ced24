"""Whole jobs of several operators: budgets, query chains, tabulation, reports."""
