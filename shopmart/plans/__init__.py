"""Marts and the jobs that store them."""
