"""Whole jobs: the local run, the nightly run and retention."""
