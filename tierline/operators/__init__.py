"""Writes, ledgers, inspection, and landing data made from tables."""
