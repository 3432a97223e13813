"""Products bought by the same customers, most similar first."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidebook.operators.affinity import similar_items


def recommendations(
    pairs: DataFrame,
    references: DataFrame,
    products: DataFrame,
    k: int = 5,
    max_references: int | None = None,
) -> DataFrame:
    """The ``k`` nearest products of each reference product, with names.

    Names are looked up for the finished ranking only; many products share a name, so nothing
    is matched by it. A product the catalogue does not list stays in the ranking. Sort by
    ``position`` where the order matters; a sort here would run the catalogue join twice.
    """
    ranked = similar_items(pairs, references, k, max_references)
    return ranked.join(products.select("product_id", "product"), "product_id", "left").select(
        "reference_id",
        "position",
        "product_id",
        "product",
        "co_buyers",
        "buyers",
        "similarity",
    )
