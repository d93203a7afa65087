"""Whole models composed from the operators."""
