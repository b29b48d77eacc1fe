"""Operators: plain functions from DataFrame(s) to DataFrame."""
