"""Reusable operators on trip relations and fact tables."""
