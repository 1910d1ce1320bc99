"""Composite jobs: silver cleaning/joins, gold marts, the layered run."""
