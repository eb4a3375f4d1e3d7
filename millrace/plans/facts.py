"""Fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_age, clock_of, second_of_day, time_part
from ..functions.keys import label_id, packed_hex, packed_key, row_hash, surrogate_key, unpacked_hex, unpacked_key
from ..functions.numbers import exact_sum
from ..operators.aggregates import pick_by_label
from ..operators.lookups import attach_keys, left_lookup
from ..operators.shape import stack_tables
from ..operators.windows import dates_with_previous
from .dimensions import INVESTMENT_DIMENSIONS, keys_only

# Event labels, the columns that make up the two hash keys, in order, and the size of a hash.
EVENT_LABELS = (
    "Acquired", "Acquiring", "IPO", "Received Funding", "Made Investment", "Funds", "Milestone",
)
EVENT_KEY = (
    "company_id", "acquisition_id", "ipos_id", "funds_id", "funding_rounds_id", "milestones_id",
    "event_type_id", "object_nk", "acquisition_nk", "ipo_nk", "fund_nk", "investment_nk",
    "funding_round_nk", "event_datetime", "event_date", "source_url", "source_description",
)
STABLE_KEY = (
    "object_nk", "event_type_id", "acquisition_nk", "ipo_nk", "fund_nk", "funding_round_nk",
    "investment_nk", "milestone_nk",
)
HASH_BYTES = 32
EVENT_COLUMNS = (
    "startup_event_id", "stable_id", "acquisition_id", "ipos_id", "funds_id", "funding_rounds_id",
    "milestones_id", "company_id", "event_type_id", "event_datetime", "event_date", "source_url",
    "source_description",
)


def dated(moment: str) -> list[Column]:
    """Date and clock of an event, which take less room than its moment, and its link."""
    at = F.col(moment).try_cast("timestamp_ntz")
    date = F.coalesce(at.cast("date"), F.col(moment).try_cast("date"))  # a text may have a date and no moment
    clock = (at - at.cast("date").cast("timestamp_ntz")).alias("clock")
    return [date.alias("event_date"), clock, F.col("source_url"), F.col("source_description")]


def role_events(df: DataFrame, columns: Sequence[str | Column], roles: Mapping[str, str]) -> DataFrame:
    """One event per row and role from one scan: {object column: event label}; the label by its place in EVENT_LABELS."""
    parts = [
        F.struct(F.lit(EVENT_LABELS.index(label)).alias("event_type"), F.col(c).alias("object_nk"))
        for c, label in roles.items()
    ]
    return df.select(F.inline(F.array(*parts)), *columns)


def company_events(
    sources: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], one_office: bool = False
) -> DataFrame:
    """The event fact: seven kinds of company events in one table with two hash keys.

    startup_event_id covers every attribute; stable_id covers the natural keys, the object and the
    kind of event, so that it outlives corrections of the attributes.

    `dims` has to hold company and funding_rounds. A key of another dimension is a hash of the event's own row
    and is made there, unless that dimension is given and the key is to be looked up in it.

    Every event is moved once, to its company, with its own kind, so that it has no columns of other kinds. Until
    then a key is bytes, or what it is made of where that is shorter; a round's key that follows from its natural
    key takes no room, and labels are numbers. An investment meets its round before it becomes two events.
    """
    def met(events: DataFrame, **keys: Column) -> DataFrame:
        """The events with their company, keys as text and whole moments."""
        found = attach_keys(events, dims["company"], {"object_nk": "company_id"}, dedupe=one_office)
        moment = F.col("event_date").cast("timestamp_ntz") + F.col("clock")
        return found.withColumns({**keys, "event_datetime": moment}).drop("clock", "made_of")

    def events_of(name: str, natural: str, roles: Mapping[str, str], moment: str) -> DataFrame:
        spec, source = INVESTMENT_DIMENSIONS[name], sources[name]
        if name in dims:
            named = [F.col(next(iter(spec.natural))).alias(natural), *dated(moment)]
            packed = dims[name].withColumn(spec.key, packed_hex(spec.key))
            events = attach_keys(role_events(source, named, roles), packed, {natural: spec.key})
            return met(events, **{spec.key: unpacked_hex(spec.key)})
        keyed = spec.with_key(source)
        rest = [c for c in spec.hashed if c != natural]
        short = reduce(add, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in rest]) <= HASH_BYTES
        key = [F.when(~short, F.unhex(spec.key)).alias(spec.key), F.when(short, F.struct(*rest)).alias("made_of")]
        events = role_events(keyed, [natural, *dated(moment), *key], roles)
        made = row_hash([c if c == natural else f"made_of.{c}" for c in spec.hashed])
        return met(events, **{spec.key: F.coalesce(F.lower(F.hex(spec.key)), made)})

    acquisition = events_of(
        "acquisition", "acquisition_nk", {"acquiring_object_id": "Acquiring", "acquired_object_id": "Acquired"}, "acquired_at")
    ipos = events_of("ipos", "ipo_nk", {"object_id": "IPO"}, "public_at")
    funds = events_of("funds", "fund_nk", {"object_id": "Funds"}, "funded_at")
    milestones = events_of("milestones", "milestone_nk", {"object_id": "Milestone"}, "milestone_at")

    spec = INVESTMENT_DIMENSIONS["funding_rounds"]
    natural, key = "funding_round_nk", spec.key
    roles = {"funded_object_id": "Received Funding", "investor_object_id": "Made Investment"}
    funded = sources["investments"].select(
        F.col("investment_id").alias("investment_nk"), F.col("funding_round_id").alias(natural), *roles
    )
    rounds = sources["funding_rounds"].select(F.col("funding_round_id").alias(natural), *dated("funded_at"))
    # The key of a round that has a natural key and nothing else; equal keys of these types are the same text.
    types = {t.schema[natural].dataType.simpleString() for t in (funded, rounds, dims["funding_rounds"])}
    plain = len(types) == 1 and types <= {"int", "bigint", "string"}
    follows = [natural if c == natural else F.lit(None) for c in spec.hashed] if plain else None
    rounds = attach_keys(rounds, dims["funding_rounds"].withColumn(key, packed_key(key, follows)), {natural: key})
    funded = funded.join(rounds, natural, "left")
    investments = role_events(funded, [c for c in funded.columns if c not in roles], roles)
    investments = met(investments, **{key: unpacked_key(key, follows)})

    labels = F.array(*[label_id(F.lit(label)) for label in EVENT_LABELS])
    keyed = stack_tables([acquisition, ipos, funds, investments, milestones]).withColumn("event_type_id", F.get(labels, "event_type"))
    return keyed.withColumns(
        {"startup_event_id": row_hash(EVENT_KEY), "stable_id": row_hash(STABLE_KEY)}
    ).select(*EVENT_COLUMNS)


# Order states in the order of their life, and the column stems they fill.
ORDER_STATES = {
    "Order Received": "order_received",
    "Pending Delivery": "pending_delivery",
    "Delivery In Progress": "delivery_in_progress",
    "Delivered": "delivered",
    "Cancelled": "cancelled",
    "Returned": "returned",
}


def state_pivot(history: DataFrame, key: str, state: str, moment: str, same_row: bool = False) -> DataFrame:
    """One row per key with the latest date and the latest time of each order state.

    Date and time are maximised on their own, as the order mart defines them. `same_row=True`
    takes both from the latest moment instead.
    """
    if same_row:
        latest = history.groupBy(key).agg(
            *pick_by_label(state, moment, {s: f"_{stem}" for s, stem in ORDER_STATES.items()})
        )
        columns = [
            c for stem in ORDER_STATES.values()
            for c in (F.to_date(f"_{stem}").alias(f"{stem}_date"), time_part(f"_{stem}").alias(f"{stem}_time"))
        ]
        return latest.select(key, *columns)
    dates = pick_by_label(state, F.to_date(moment), {s: f"{stem}_date" for s, stem in ORDER_STATES.items()})
    times = pick_by_label(state, second_of_day(moment), {s: f"{stem}_time" for s, stem in ORDER_STATES.items()})
    grouped = history.groupBy(key).agg(*[c for pair in zip(dates, times) for c in pair])
    clocks = [f"{stem}_time" for stem in ORDER_STATES.values()]
    return grouped.withColumns({c: F.when(F.col(c).isNotNull(), clock_of(c)) for c in clocks})


def order_lines(
    sources: Mapping[str, DataFrame], dim_date: DataFrame, dim_time: DataFrame,
    dim_customer: DataFrame | None = None, dim_address: DataFrame | None = None, dim_book: DataFrame | None = None,
) -> DataFrame:
    """The order lifecycle fact: one row per order line, ten sources.

    Keys are made from the natural keys of the sources unless dimensions are given; pass current rows of a
    history, not the history. No side is broadcast by force: Spark sees the size of the calendar and of the other small
    tables. Everything known per order is joined before the order lines multiply the rows.
    """
    dim_customer = dim_customer or keys_only(sources["customer"], "customer_id", "customer")
    dim_address = dim_address or keys_only(sources["address"], "address_id", "address")
    dim_book = dim_book or keys_only(sources["book"], "book_id", "book")
    orders = sources["cust_order"].select(
        F.col("order_id").alias("nk_order_id"),
        F.to_date("order_date").alias("order_date"),
        time_part("order_date").alias("order_time"),
        F.col("customer_id").alias("nk_customer_id"),
        F.col("shipping_method_id").alias("nk_shipping_method_id"),
        F.col("dest_address_id").alias("nk_dest_address_id"),
    )
    history = left_lookup(
        sources["order_history"], sources["order_status"], {"status_id": "status_id"}, {"state": "status_value"}
    )
    states = state_pivot(history, "order_id", "state", "status_date").withColumnRenamed("order_id", "nk_order_id")
    address_states = left_lookup(
        sources["customer_address"], sources["address_status"], {"status_id": "status_id"},
        {"dest_address_status": "address_status"},
    )
    minute = F.concat(F.substring("order_time", 1, 5), F.lit(":00"))
    facts = left_lookup(orders, dim_date, {"date_day": "order_date"}, {"sk_date_id": "sk_date_id"})
    facts = left_lookup(facts, dim_time, {"time_actual": minute}, {"time_id": "time_id"})
    facts = left_lookup(
        facts, sources["shipping_method"], {"method_id": "nk_shipping_method_id"},
        {"shipping_method_name": "method_name", "shipping_method_cost": "cost"},
    )
    facts = left_lookup(facts, dim_address, {"nk_address_id": "nk_dest_address_id"}, {"sk_address_id": "sk_address_id"})
    facts = left_lookup(facts, dim_customer, {"nk_customer_id": "nk_customer_id"}, {"sk_customer_id": "sk_customer_id"})
    facts = left_lookup(
        facts, address_states, {"customer_id": "nk_customer_id", "address_id": "nk_dest_address_id"},
        {"nk_customer_address_status_id": "status_id", "dest_address_status": "dest_address_status"},
    )
    facts = facts.join(states, "nk_order_id", "left")
    # Lines are narrow: they meet their book before they take the order's columns.
    lines = left_lookup(
        sources["order_line"].select("line_id", "order_id", "book_id", "price"), dim_book,
        {"nk_book_id": "book_id"}, {"sk_book_id": "sk_book_id"},
    )
    facts = left_lookup(
        facts, lines, {"order_id": "nk_order_id"},
        {"nk_line_id": "line_id", "nk_book_id": "book_id", "order_line_price": "price", "sk_book_id": "sk_book_id"},
    )
    state_columns = [f"{stem}_{part}" for stem in ORDER_STATES.values() for part in ("date", "time")]
    return facts.select(
        surrogate_key("nk_line_id").alias("sk_line_id"),
        "sk_customer_id", "sk_address_id", "sk_book_id", "sk_date_id", "time_id", "nk_order_id",
        "order_date", "order_time", "nk_shipping_method_id", "nk_dest_address_id", *state_columns,
        "nk_customer_address_status_id", "dest_address_status", "shipping_method_name",
        "shipping_method_cost", "nk_line_id", "nk_book_id", "order_line_price",
    )


def customer_behaviour(cust_order: DataFrame, order_line: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row per customer: gaps between orders, order value, frequency and last order.

    Orders are first counted per customer and date. Orders of one date are no time apart, so only
    the step from the date before counts: n orders on a date are n gaps, or n - 1 on the first
    date. This keeps the window at one row per date however many orders a customer has.
    """
    days = dates_with_previous(cust_order, ["customer_id"], "order_date")
    age = calendar_age("date", "previous_date")
    gaps = F.sum(F.when(F.col("previous_date").isNull(), F.col("n") - 1).otherwise(F.col("n")))
    known = F.col("date").isNotNull()

    def mean(total):
        return F.coalesce(F.sum(F.coalesce(total, F.lit(0))).cast("double") / F.nullif(gaps, F.lit(0)), F.lit(0.0))

    times = days.where(known).groupBy("customer_id").agg(
        mean(age.days.cast("decimal(18,2)")).alias("avg_days_between_orders"),
        mean(age.months).alias("avg_months_between_orders"),
        mean(age.years).alias("avg_years_between_orders"),
        F.max("date").alias("last_order_date"),
    )
    per_order = order_line.groupBy("order_id").agg(exact_sum("price").alias("amount"))
    values = (
        cust_order.select("order_id", "customer_id")
        .join(per_order, "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("amount").alias("order_frequency"),  # orders come once each
            (F.sum("amount").cast("double") / F.nullif(F.count("amount"), F.lit(0))).alias("average_order_value"),
        )
    )
    joined = times.join(values, "customer_id", "left")
    dated = left_lookup(joined, dim_date, {"date_day": "last_order_date"}, {"sk_date_id": "sk_date_id"})
    return dated.select(
        surrogate_key("customer_id").alias("sk_customer_id"),
        "sk_date_id", F.col("customer_id").alias("nk_customer_id"),
        "avg_days_between_orders", "avg_months_between_orders", "avg_years_between_orders",
        "last_order_date", "order_frequency", "average_order_value",
    )
