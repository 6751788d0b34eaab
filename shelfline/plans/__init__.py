"""Layered models and the jobs that chain operators."""
