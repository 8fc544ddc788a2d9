"""Composed plans: fixture mapping, Silver builds, run log, sync runs."""
