"""Inputs: source registry, landing files, lake tables."""
