"""Outputs: append tables, snapshots, quarantine, serving database."""
