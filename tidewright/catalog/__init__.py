"""Runnable queries over the sample tables, one or more per operator, with their check SQL."""
