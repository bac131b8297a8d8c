"""Whole plans composed from the operators: the close pipeline and the dashboard views."""
