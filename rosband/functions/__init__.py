"""Column-expression builders.  Everything here returns a ``Column`` that stays
inside whole-stage codegen (no Python UDFs)."""
