"""Relational operators over detections and their surroundings."""
