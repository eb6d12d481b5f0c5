"""Compose the layers: bronze -> silver -> intermediate -> gold.

Functions only compose lazy DataFrames; Catalyst plans each read end to
end.  ``persist`` writes layer tables at the layer edges (parquet in the
shared folder) so a gold read scans each bronze source once instead of
re-expanding every upstream view, as the reference's all-view design does.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import conform, dims, facts, quality


@dataclass
class Layers:
    staged: dict[str, DataFrame] = field(default_factory=dict)
    valid: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)


def silver(bronze: dict[str, DataFrame], raw: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    raw = raw or {}
    return {s: conform.STAGERS[s](df, raw.get(s)) for s, df in bronze.items()}


def intermediate(staged: dict[str, DataFrame]) -> tuple[dict, dict]:
    """The valid split looks for keys with good and rejected rows first (see
    ``quality.settled``); the sources' passes are submitted together."""
    if not staged:
        return {}, {}
    with ThreadPoolExecutor(max_workers=len(staged)) as pool:
        valid = dict(zip(staged, pool.map(lambda s: quality.settled(staged[s], quality.RULES[s], s), staged), strict=True))
    return valid, {s: quality.rejected(df, quality.RULES[s]) for s, df in staged.items()}


def gold(valid: dict[str, DataFrame], scope: DataFrame) -> dict[str, DataFrame]:
    d_outlet = dims.dim_outlet(valid["outlet"], valid["matching"])
    d_product = dims.dim_product(valid["portfolio"])
    return {
        "dim_market": dims.dim_market(scope),
        "dim_platform": dims.dim_platform(valid["outlet"]),
        "dim_outlet": d_outlet,
        "dim_product": d_product,
        # dim_product comes from the same valid listings: product keys need no join
        "fct_outlet_product_listing": facts.fct_listing(valid["portfolio"], d_outlet),
    }


def _keep_all(persist, items: dict[str, tuple[DataFrame, str, str]]) -> dict[str, DataFrame]:
    """Persist independent tables of one layer together: their jobs are
    submitted concurrently and share the cluster instead of queueing."""
    if not items:
        return {}
    with ThreadPoolExecutor(max_workers=min(8, len(items))) as pool:
        futures = {k: pool.submit(persist, df, layer, name) for k, (df, layer, name) in items.items()}
        return {k: f.result() for k, f in futures.items()}


def build(bronze: dict[str, DataFrame], scope: DataFrame, raw: dict[str, DataFrame] | None = None,
          persist=None, persist_staged: bool = True, persist_rejected: bool = True) -> Layers:
    """All layers.  ``persist(df, layer, name) -> DataFrame`` materialises a
    layer table and returns a DataFrame reading it back (see sources.layers);
    each layer is then built from the persisted tables of the layer below,
    so every upstream table is computed once.  Staged and rejected tables
    can stay views when bronze is already a table (they are one cheap
    projection / filter of it)."""
    if persist is None:
        staged = silver(bronze, raw)
        valid, rejected = intermediate(staged)
        return Layers(staged, valid, rejected, gold(valid, scope))
    staged = silver(bronze, raw)
    if persist_staged:
        staged = _keep_all(persist, {s: (df, "silver", f"stg_{s}") for s, df in staged.items()})
    valid, rejected = intermediate(staged)
    items = {("v", s): (df, "silver", f"int_{s}_valid") for s, df in valid.items()}
    if persist_rejected:
        items.update({("r", s): (df, "silver", f"int_{s}_rejected") for s, df in rejected.items()})
    kept = _keep_all(persist, items)
    valid = {s: kept[("v", s)] for s in valid}
    rejected = {s: kept.get(("r", s), df) for s, df in rejected.items()}
    d = _keep_all(persist, {
        "dim_market": (dims.dim_market(scope), "gold", "dim_market"),
        "dim_platform": (dims.dim_platform(valid["outlet"]), "gold", "dim_platform"),
        "dim_outlet": (dims.dim_outlet(valid["outlet"], valid["matching"]), "gold", "dim_outlet"),
        "dim_product": (dims.dim_product(valid["portfolio"]), "gold", "dim_product"),
    })
    fact = facts.fct_listing(valid["portfolio"], d["dim_outlet"])
    d["fct_outlet_product_listing"] = persist(fact, "gold", "fct_outlet_product_listing")
    return Layers(staged, valid, rejected, d)
