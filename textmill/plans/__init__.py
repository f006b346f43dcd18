"""Whole jobs: corpus build, split comparison, outlier report."""
