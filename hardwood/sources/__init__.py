"""Raw extracts in, stage tables out."""
