"""Operators for preparing language-model training data (see README, "Training data")."""
