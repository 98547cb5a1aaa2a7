"""The operators that hold state, as streams."""
