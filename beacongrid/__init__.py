"""Incident analytics as DataFrame operators."""
