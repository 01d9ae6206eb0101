"""Whole jobs: the layered pipeline and the defect classifier."""
