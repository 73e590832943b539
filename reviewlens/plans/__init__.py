"""Stages that chain the operators and keep their results as tables."""
