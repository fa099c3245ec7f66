"""Composition of sources, transforms and outputs into lazy plans."""
