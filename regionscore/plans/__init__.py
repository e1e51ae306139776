"""Whole dataflows: region features, listing scores, region scores."""
