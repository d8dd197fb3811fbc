"""Lazy DataFrame -> DataFrame operators; only the check for unique zone ids runs an action."""
