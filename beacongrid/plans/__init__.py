"""Bindings of the bundled tables, and the queries over them."""
