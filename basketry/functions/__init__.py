"""Column-expression builders. Everything here returns a ``Column`` and stays
inside Catalyst / whole-stage codegen (no Python UDFs)."""
