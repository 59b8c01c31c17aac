"""Whole jobs: a load pass, a relocation pass, a feed sync."""
