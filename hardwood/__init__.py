"""A layered sports warehouse expressed as Spark jobs.

Raw extracts land in an append-only stage layer, per-key deltas are merged into
dimensions and facts, and star-join marts are rebuilt from those.
"""
