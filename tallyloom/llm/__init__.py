"""Operators and a pipeline that prepare text for training language models."""
