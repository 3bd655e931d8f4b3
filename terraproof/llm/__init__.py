"""Operators for training-data pipelines.

Nothing outside this subpackage imports it; ``queries`` holds what the entry point registers.
"""
