"""Tracker reconciliation and reporting on Spark."""
