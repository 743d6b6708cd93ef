"""Registered queries by topic. All of them read whole tables."""
