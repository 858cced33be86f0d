"""Readers for fact tables, dimensions and configuration documents."""
