"""The published marts: their headers, their checks, and how each is built."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.functions.numbers import cents, from_cents, ratio, round2, wide_sum
from tidebook.operators.affinity import purchases, references
from tidebook.plans.customers import loyal_categories, loyal_customers, rank_customers
from tidebook.plans.demand import demand_forecast
from tidebook.plans.overview import sales_cube, sales_kpis
from tidebook.plans.recommend import recommendations
from tidebook.plans.weekdays import WORST, weekday_average
from tidebook.sources.mart_files import Check, Mart
from tidebook.sources.star import Sales


@dataclass(frozen=True)
class Contract:
    """Source column to published column, in file order, and the sort of the file."""

    columns: dict[str, str]
    order: tuple[str, ...]

    def mart(
        self, df: DataFrame, checks: list[Check], approved: DataFrame | None = None
    ) -> Mart:
        rows = df.select([F.col(ours).alias(published) for ours, published in self.columns.items()])
        return Mart(rows, self.order, checks, approved)


# Headers of the published files.
LOYAL_CUSTOMERS = Contract(
    {
        "customer_id": "customer_id",
        "customer": "cliente",
        "revenue": "faturamento_total",
        "frequency": "frequencia",
        "average_ticket": "ticket_medio",
        "category_diversity": "diversidade_categorias",
        "position": "posicao",
    },
    ("posicao",),
)
LOYAL_CATEGORIES = Contract(
    {
        "category_id": "category_id",
        "category": "categoria",
        "n_items": "quantidade_itens",
        "position": "posicao",
    },
    ("posicao",),
)
WEEKDAYS = Contract(
    {
        "weekday": "ordem_dia",
        "weekday_name": "dia_semana",
        "average_sales": "media_vendas",
        "calendar_days": "dias_calendario",
        "days_without_sales": "dias_sem_venda",
        "total_value": "valor_total",
        "label": "destaque",
    },
    ("ordem_dia",),
)
FORECAST = Contract(
    {
        "month": "mes",
        "actual": "real",
        "predicted": "previsto",
        "abs_error": "erro_absoluto",
    },
    ("mes",),
)
RECOMMENDATIONS = Contract(
    {
        "position": "posicao",
        "product_id": "product_id",
        "product": "produto",
        "similarity": "similaridade",
    },
    ("posicao",),
)
# The header of the overview file is not known; these names follow the others.
OVERVIEW = Contract(
    {
        "month": "mes",
        "channel": "canal",
        "status": "status",
        "n_orders": "pedidos",
        "total_value": "valor_total",
        "average_ticket": "ticket_medio",
    },
    ("mes", "canal", "status"),
)


# Nor is that of the totals known.
KPIS = Contract(
    {
        "total_value": "valor_total",
        "n_orders": "pedidos",
        "n_customers": "clientes",
        "average_ticket": "ticket_medio",
    },
    ("pedidos",),
)


def overview_rows(cube: DataFrame) -> DataFrame:
    value = from_cents(F.col("cents"))
    return cube.select(
        "month",
        "channel",
        "status",
        "n_orders",
        value.alias("total_value"),
        round2(ratio(value, F.col("n_orders"))).alias("average_ticket"),
    )


def ranking_checks(metric: str, n: int | None = None) -> list[Check]:
    """Positions are 1, 2, ... without gaps, up to ``n`` at most, and the best value comes first."""
    last, best = F.max("posicao"), F.max_by(metric, -F.col("posicao"))
    checks = [
        Check("first position", F.min("posicao"), 1),
        Check("gaps in positions", last - F.count_distinct("posicao"), 0),
        Check("repeated positions", F.count("*") - F.count_distinct("posicao"), 0),
        Check("best value first", F.max(metric) == best, True),
    ]
    return checks if n is None else [*checks, Check(f"at most {n} positions", last <= n, True)]


def similarity_checks(n: int) -> list[Check]:
    """Positions are sound and every similarity lies between 0 and 1.

    The order is not compared: equal similarities may differ in their last digit.
    """
    outside = ~F.col("similaridade").between(0.0, 1.0 + 1e-12)
    return [
        Check("first position", F.min("posicao"), 1),
        Check("positions", F.max("posicao") == F.count_distinct("posicao"), True),
        Check(f"at most {n} positions", F.max("posicao") <= n, True),
        Check("similarities out of range", F.count_if(outside), 0),
    ]


def ticket_check() -> Check:
    """Every average is its total over its count, rounded by the house rule."""
    expected = round2(ratio(F.col("faturamento_total"), F.col("frequencia")))
    return Check("rows with a wrong ticket", F.count_if(F.col("ticket_medio") != expected), 0)


def weekday_checks(orders: DataFrame, channel: str | list[str] | None) -> list[Check]:
    """The weekday totals must add up to the channel's orders, counted independently."""
    wanted = orders if channel is None else orders.filter(F.col("channel").isin(channel))
    dated = wanted.filter(F.col("order_date").isNotNull())
    total = dated.agg(wide_sum(cents(F.col("total")))).first()[0]
    average = round2(ratio(F.col("valor_total"), F.col("dias_calendario")))
    return [
        Check("weekdays", F.count("*"), 7),
        Check("worst weekdays", F.count_if(F.col("destaque") == WORST), 1),
        Check("rows with a wrong average", F.count_if(F.col("media_vendas") != average), 0),
        Check("cents sold", wide_sum(cents(F.col("valor_total"))), total),
    ]


def overview_checks(orders: DataFrame) -> list[Check]:
    return [Check("orders", F.sum("pedidos"), orders.count())]


def error_check() -> Check:
    wrong = F.col("erro_absoluto") != F.abs(F.col("real") - F.col("previsto"))
    return Check("rows with a wrong error", F.count_if(wrong), 0)


def filled_check(*columns: str) -> Check:
    """The columns that a row cannot do without have values."""
    missing = F.count_if(F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False)))
    return Check(f"rows without {' or '.join(columns)}", missing, 0)


def kpi_checks() -> list[Check]:
    ticket = round2(ratio(F.col("valor_total"), F.col("pedidos")))
    return [
        Check("rows", F.count("*"), 1),
        filled_check("valor_total", "pedidos", "clientes"),
        Check("rows with a wrong ticket", F.count_if(F.col("ticket_medio") != ticket), 0),
    ]


def build_marts(
    sales: Sales,
    channel: str | list[str] | None,
    reference_id: int,
    test_from: date,
    test_to: date,
    n_customers: int = 10,
    neighbours: int = 5,
    approved: dict[str, DataFrame] | None = None,
) -> dict[str, Mart]:
    """The seven marts; the product ``reference_id`` is forecast and compared with the others.

    ``approved`` has the rows that marts must have to be published, by the name of the mart.
    """
    orders, items, products, customers = sales
    ranking = rank_customers(orders, items, products, n=n_customers)
    loyal = loyal_customers(orders, items, products, customers, ranking)
    categories = loyal_categories(orders, items, products, ranking)
    reference = references(orders.sparkSession, [reference_id])
    similar = recommendations(purchases(orders, items), reference, products, neighbours, 1)
    built = {
        "kpis": KPIS.mart(sales_kpis(orders), kpi_checks()),
        "overview": overview_mart(orders),
        "loyal_customers": LOYAL_CUSTOMERS.mart(
            loyal, [*ranking_checks("ticket_medio", n_customers), ticket_check()]
        ),
        "loyal_categories": LOYAL_CATEGORIES.mart(categories, ranking_checks("quantidade_itens")),
        "weekdays": WEEKDAYS.mart(
            weekday_average(orders, channel), weekday_checks(orders, channel)
        ),
        "forecast": forecast_mart(orders, items, products, reference_id, test_from, test_to),
        "recommendations": RECOMMENDATIONS.mart(similar, similarity_checks(neighbours)),
    }
    if unknown := set(approved or {}) - set(built):
        raise ValueError(f"approved rows for unknown marts: {sorted(unknown)}")
    return {name: replace(mart, approved=(approved or {}).get(name)) for name, mart in built.items()}


def overview_mart(orders: DataFrame) -> Mart:
    return OVERVIEW.mart(overview_rows(sales_cube(orders)), overview_checks(orders))


def forecast_mart(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    reference_id: int,
    test_from: date,
    test_to: date,
) -> Mart:
    """The product filter goes down to both scans; only its items are joined to the orders."""
    wanted = F.col("product_id") == reference_id
    forecast = demand_forecast(
        orders, items.filter(wanted), products.filter(wanted), test_from, test_to
    )
    months = 12 * (test_to.year - test_from.year) + test_to.month - test_from.month + 1
    return FORECAST.mart(forecast, [Check("months", F.count("*"), months), filled_check("mes", "real"), error_check()])
