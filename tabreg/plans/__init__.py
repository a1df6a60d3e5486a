"""Composed plans: the flight fixture, workflows and the registered queries."""
