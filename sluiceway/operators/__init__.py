"""Reusable DataFrame operators; columns, rules and limits come in as arguments."""
