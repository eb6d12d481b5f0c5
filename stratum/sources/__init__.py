"""Where data comes from and goes to.

schemas (bronze layouts), ingest (landed files -> raw / parsed bronze),
landing (writing delimited files), layers (layer tables and views),
constants (market scope, coverage, entitlements), standins and friends
(bronze-shaped data derived from the driver's tables).
"""
