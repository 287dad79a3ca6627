"""Operators and a pipeline for preparing text corpora for training language models."""
