"""Operators for building training data: one module per operator, each with its query and, where SQL can say it, its SQL."""
