"""Relational operators over manifests, pages and snapshots: DataFrame in, DataFrame out, nothing collected."""
