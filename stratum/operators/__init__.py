"""DataFrame -> DataFrame operators of the listing model.

conform (silver typing), quality (valid / rejected split), dims and facts
(gold star schema), checks (declared data-quality tests), audit (source
coverage), access (per-role market rows), labels (listing classification),
monitoring (layer reconciliation, freshness, history and other signals).
"""
