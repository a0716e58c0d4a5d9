"""Operators for preparing training text. Nothing outside this package imports it."""

#: Modules of this package with registered queries.
PLANS: list[str] = ["quality", "leaks", "canonical", "spans", "confusables", "noise", "packing"]
