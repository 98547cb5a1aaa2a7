"""Operators for preparing training text: extraction, scoring, filtering, dedup, sharding, tokenising."""
