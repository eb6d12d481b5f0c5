"""Compositions: layer build, end-to-end run, registered queries, oracle SQL."""
