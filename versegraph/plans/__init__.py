"""Registered queries: ``queries`` maps a name to a callable, ``oracles`` to its SQL."""
