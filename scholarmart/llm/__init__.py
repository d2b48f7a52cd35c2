"""Operators for training-data pipelines over ``documents``; nothing outside this folder imports it."""
