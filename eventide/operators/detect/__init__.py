"""Anomaly detectors: volume (STAT), schema drift (DRIFT), content (EMB)."""
