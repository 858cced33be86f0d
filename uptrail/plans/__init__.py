"""Whole jobs: availability, status, recomputation, legacy reports."""
