"""Whole queries made of the operators."""
