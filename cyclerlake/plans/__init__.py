"""Whole queries: records of a test, measurements of a test or a fleet, exports."""
