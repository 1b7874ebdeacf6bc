"""Column expressions: ``text``, ``lists``, ``jsonx``, ``predicates``."""
