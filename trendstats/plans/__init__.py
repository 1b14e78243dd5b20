"""Composed plans: the registered query catalog, its SQL oracle, and the
menu / standalone-job entry points."""
