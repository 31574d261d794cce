"""Inputs by logical name, and the outputs of a run."""
