"""Registered queries and, next to them, independent SQL that must give the same rows."""
