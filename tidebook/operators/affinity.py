"""Product similarity: cosine of the binary customer x product matrix, kept as sparse pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.operators.ranking import top_per_group

# Up to this many reference products are sent to every executor.
BROADCAST_REFERENCES = 10_000


def purchases(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The non-zero cells of the matrix: who bought what, each pair once.

    ``distinct`` runs once in every task before the shuffle, and the shuffle is on both columns,
    so neither a hot customer nor a hot product lands in one task.
    """
    bought = items.select("order_id", "product_id").join(
        orders.select("order_id", "customer_id"), "order_id"
    )
    return (
        bought.filter(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
        .select("customer_id", "product_id")
        .distinct()
    )


def buyers_per_product(pairs: DataFrame) -> DataFrame:
    """Squared column norms of the binary matrix."""
    return pairs.groupBy("product_id").agg(F.count("*").alias("buyers"))


def best_sellers(pairs: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` products with the most buyers, as reference products."""
    ranked = buyers_per_product(pairs).orderBy(F.desc("buyers"), F.asc("product_id"))
    return ranked.limit(n).select("product_id")


def references(spark: SparkSession, product_ids: list[int]) -> DataFrame:
    """Reference products given by id."""
    return spark.createDataFrame([(i,) for i in product_ids], "product_id bigint")


def category_leaders(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """The product with the most buyers in each category."""
    counted = buyers_per_product(pairs).join(products.select("product_id", "category_id"), "product_id")
    leader = F.max_by("product_id", F.struct(F.col("buyers"), -F.col("product_id")))
    return counted.groupBy("category_id").agg(leader.alias("product_id"))


def count_categories(products: DataFrame) -> int:
    """Number of categories, counted up to just above ``BROADCAST_REFERENCES``.

    Bounds the number of category leaders before the purchases are touched.
    """
    return products.select("category_id").distinct().limit(BROADCAST_REFERENCES + 1).count()


def co_buyers(
    pairs: DataFrame, references: DataFrame, max_references: int | None = None
) -> DataFrame:
    """Dot products of the reference columns with all others: customers who bought both.

    The self join is restricted to buyers of a reference, so a customer with a basket of b
    products, r of them references, yields r*b rows and never b*b. A customer holding a large
    share of all pairs makes a skewed partition that AQE splits; the counts are combined in every
    task before the last shuffle.

    ``max_references`` is a known bound on the list. A short list is sent to the pairs, which
    then need no shuffle to find the buyers; without a bound AQE decides.
    """
    wanted = references.select(F.col("product_id").alias("reference_id")).distinct()
    if max_references is not None and max_references <= BROADCAST_REFERENCES:
        wanted = F.broadcast(wanted)
    buyers = pairs.join(wanted, F.col("product_id") == F.col("reference_id")).select(
        "customer_id", "reference_id"
    )
    return (
        pairs.join(buyers, "customer_id")
        .filter(F.col("product_id") != F.col("reference_id"))
        .groupBy("reference_id", "product_id")
        .agg(F.count("*").alias("co_buyers"))
    )


def similar_items(
    pairs: DataFrame, references: DataFrame, k: int = 5, max_references: int | None = None
) -> DataFrame:
    """The ``k`` products most similar to each reference product, the reference left out by id.

    Ranking uses co^2/n, which orders like the cosine for a fixed reference but is a single
    division of whole numbers: equal similarities are equal doubles and fall back to the
    product id. The last digit of a square root would decide such ties at random.
    """
    counts = buyers_per_product(pairs)
    reference_counts = counts.select(
        F.col("product_id").alias("reference_id"), F.col("buyers").alias("reference_buyers")
    )
    scored = co_buyers(pairs, references, max_references).join(counts, "product_id")
    score = F.col("co_buyers").cast("double") * F.col("co_buyers") / F.col("buyers")
    best = top_per_group(scored, ["reference_id"], [score.desc(), F.asc("product_id")], k)
    norms = F.sqrt(F.col("reference_buyers").cast("double") * F.col("buyers"))
    return best.join(reference_counts, "reference_id").select(
        "reference_id",
        "position",
        "product_id",
        "co_buyers",
        "buyers",
        "reference_buyers",
        (F.col("co_buyers").cast("double") / norms).alias("similarity"),
    )
