"""Operators for building training data: mixing, deduplication, decontamination, scans, classifiers and token output."""
