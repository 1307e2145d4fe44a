"""Operators composed into detections and the detection-investigation-response chain."""
