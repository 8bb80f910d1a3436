"""Composed flows, registered queries and their SQL oracles."""
