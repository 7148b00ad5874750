"""Streams of landed manifests and pages: the same snapshot operators, batch by batch."""
