"""Operators for training data: text in, decisions, spans, groups and sequences out."""
