"""Warehouse-logistics reports on Spark."""
