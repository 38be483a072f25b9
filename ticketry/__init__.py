"""Ticket analytics as lazy DataFrame functions on Spark."""
