"""Whole computations: extraction, derivation and screens."""
