"""Whole warehouse runs: the investment warehouse and the order mart."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as q
from ..operators.history import current_rows, snapshot
from ..operators.shape import add_row_hash, stamp
from ..sinks.runlog import RunLog
from ..sinks.writers import load_warehouse, stage_tables, write_table
from . import dimensions as d
from .calendar import date_dimension, days, mart_date_dimension, time_dimension
from .facts import EVENT_LABELS, company_events, customer_behaviour, order_lines

INVESTMENT_SOURCES = (
    "company", "acquisition", "ipos", "funds", "funding_rounds", "investments", "people", "relationships", "milestones",
)


def hash_tables(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]], name: str = "row_hash") -> dict[str, DataFrame]:
    """A change-detection hash on each table, over the columns listed for it."""
    return {n: add_row_hash(df, columns[n], name) if n in columns else df for n, df in tables.items()}


def investment_tables(
    sources: Mapping[str, DataFrame], calendar: tuple[str, str] = ("1950-01-01", "2050-12-31"),
    run_time: str | None = None, one_office: bool = False,
) -> dict[str, DataFrame]:
    """The nine dimensions, the calendar, the event types and the event fact, stamped with the run time."""
    spark = next(iter(sources.values())).sparkSession
    tables = d.investment_dimensions(sources, one_office)
    labels = spark.createDataFrame([(e,) for e in EVENT_LABELS], "event_type string")
    tables["startup_event"] = company_events(sources, {n: tables[n] for n in ("company", "funding_rounds")}, one_office)
    tables["event_type"] = d.event_type_table(labels, "event_type")
    tables["date"] = date_dimension(days(spark, *calendar))
    if run_time is None:  # one time for all tables
        run_time = str(spark.range(1).select(F.localtimestamp()).first()[0])
    return {name: stamp(df, run_time) for name, df in tables.items()}


def run_investment_warehouse(
    spark: SparkSession, sources: Mapping[str, DataFrame], staging: str, warehouse: str, log: RunLog, **options
) -> list[str]:
    """Stage the sources, read them back, build, write, check, and publish the warehouse tables."""
    log.run("staging", "load", "source", "all", lambda: stage_tables(sources, staging))
    staged = {n: spark.read.parquet(f"{staging}/{n}") for n in sources}
    tables = log.run("warehouse", "transform", "staging", "all", lambda: investment_tables(staged, **options))
    facts = frozenset({"startup_event"})

    def checks(written: Mapping[str, DataFrame]) -> q.Suite:
        return q.Suite().add("startup_event", written["fct_startup_event"], [q.not_null("startup_event_id")])

    return log.run("warehouse", "load", "staging", "all", lambda: load_warehouse(tables, warehouse, facts, checks))


@dataclass(frozen=True)
class MartTable:
    """History settings and declared checks of one mart table."""

    key: tuple[str, ...]
    watched: tuple[str, ...] | None = None  # None: every column
    snapshot: bool = True
    not_null: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    foreign: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    ordered: tuple[tuple[str, str], ...] = ()


# Keys, watched columns and the 69 declared checks of the order mart.
ORDER_MART = {
    "dim_time": MartTable(("time_id",), snapshot=False),
    "dim_date": MartTable(("sk_date_id",), snapshot=False),
    "dim_address": MartTable(
        ("sk_address_id",), ("nk_address_id", "street_name", "city", "nk_country_id", "country_name"),
        not_null=("city", "country_name"),
    ),
    "dim_author": MartTable(("sk_author_id",), ("nk_author_id", "author_name"), not_null=("author_name",)),
    "dim_book": MartTable(
        ("sk_book_id",),
        (
            "nk_book_id", "title", "isbn13", "nk_language_id", "num_pages", "publication_date", "nk_publisher_id",
            "publisher_name", "language_code", "language_name",
        ),
        not_null=("title", "isbn13", "publisher_name", "language_name"),
    ),
    "bridge_book_author": MartTable(
        ("sk_author_id", "sk_book_id"), ("nk_author_id", "nk_book_id"),
        foreign={"sk_author_id": ("dim_author", "sk_author_id"), "sk_book_id": ("dim_book", "sk_book_id")},
    ),
    "dim_customer": MartTable(
        ("sk_customer_id",), ("nk_customer_id", "first_name", "last_name", "email"), not_null=("first_name", "email"),
    ),
    "fct_book_order": MartTable(
        ("sk_line_id",),
        not_null=("order_date", "order_time", "order_line_price"),
        not_negative=("order_line_price",),
        foreign={
            "sk_customer_id": ("dim_customer", "sk_customer_id"), "sk_address_id": ("dim_address", "sk_address_id"),
            "sk_book_id": ("dim_book", "sk_book_id"), "sk_date_id": ("dim_date", "sk_date_id"),
            "time_id": ("dim_time", "time_id"),
        },
        ordered=(
            ("order_received_date", "pending_delivery_date"),
            ("pending_delivery_date", "delivery_in_progress_date"),
            ("delivery_in_progress_date", "delivered_date"),
        ),
    ),
    "fct_customer_behavior": MartTable(
        ("sk_customer_id",),
        not_null=(
            "order_frequency", "avg_days_between_orders", "avg_months_between_orders", "avg_years_between_orders",
            "last_order_date", "average_order_value",
        ),
        not_negative=(
            "order_frequency", "avg_days_between_orders", "avg_months_between_orders", "avg_years_between_orders",
            "average_order_value",
        ),
        foreign={"sk_customer_id": ("dim_customer", "sk_customer_id"), "sk_date_id": ("dim_date", "sk_date_id")},
    ),
}


def order_mart(sources: Mapping[str, DataFrame], dim_date: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables of the order mart as they are now."""
    spark = sources["cust_order"].sparkSession
    if dim_date is None:
        dim_date = mart_date_dimension(days(spark, "1990-01-01", "2050-12-31", end_included=False))
    mart = {
        "dim_time": time_dimension(spark),
        "dim_date": dim_date,
        "dim_address": d.address_dimension(sources["address"], sources["country"]),
        "dim_author": d.author_dimension(sources["author"]),
        "dim_book": d.book_dimension(sources["book"], sources["publisher"], sources["book_language"]),
        "bridge_book_author": d.author_bridge(sources["book_author"]),
        "dim_customer": d.customer_dimension(sources["customer"]),
    }
    mart["fct_book_order"] = order_lines(
        sources, dim_date, mart["dim_time"], mart["dim_customer"], mart["dim_address"], mart["dim_book"]
    )
    mart["fct_customer_behavior"] = customer_behaviour(sources["cust_order"], sources["order_line"], dim_date)
    return mart


def order_mart_checks(mart: Mapping[str, DataFrame]) -> q.Suite:
    """The declared checks on the current rows of each table."""
    suite = q.Suite()
    for name, spec in ORDER_MART.items():
        df = mart[name]
        required = dict.fromkeys([*(spec.key if len(spec.key) == 1 else ()), *spec.foreign, *spec.not_null])
        row_checks = [q.not_null(c) for c in required]
        row_checks += [q.not_negative(c) for c in spec.not_negative]
        row_checks += [q.date_order(a, b) for a, b in spec.ordered]
        table_checks = [q.unique(df, *spec.key)] if len(spec.key) == 1 else []
        table_checks.append(q.primary_key(df, *spec.key))
        table_checks += [q.foreign_key(df, mart[p], {c: pc}) for c, (p, pc) in spec.foreign.items()]
        suite.add(name, df, row_checks, table_checks)
    return suite


def order_mart_history(
    mart: Mapping[str, DataFrame], previous: Mapping[str, DataFrame], run_time: str
) -> dict[str, DataFrame]:
    """The history of every table after this run; the calendar tables are replaced."""
    return {
        name: snapshot(previous.get(name), mart[name], spec.key, run_time, spec.watched) if spec.snapshot else mart[name]
        for name, spec in ORDER_MART.items()
    }


def run_order_mart(
    spark: SparkSession, sources: Mapping[str, DataFrame], location: str, run: int, run_time: str, log: RunLog,
    dim_date: DataFrame | None = None,
) -> DataFrame:
    """One run of the order mart: build, add to the history of run `run - 1`, check the current rows.

    Each run writes its own folder, so a run that fails half-way can be repeated. Returns the report
    of the checks.
    """
    here, before = f"{location}/run={run:06d}", f"{location}/run={run - 1:06d}"
    previous = {n: spark.read.parquet(f"{before}/{n}") for n in ORDER_MART} if run else {}
    mart = order_mart(sources, dim_date)
    for name, df in order_mart_history(mart, previous, run_time).items():
        log.run("mart", "snapshot", "sources", name, lambda n=name, t=df: write_table(t, here, n))
    written = {n: spark.read.parquet(f"{here}/{n}") for n in ORDER_MART}
    current = {n: current_rows(df) if ORDER_MART[n].snapshot else df for n, df in written.items()}
    return order_mart_checks(current).report()
