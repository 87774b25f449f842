"""Configurations, whole jobs and registered queries."""
