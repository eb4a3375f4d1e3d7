"""Dimension builds of the investment and the order warehouse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import packed_hex, surrogate_key, unpacked_hex
from ..operators.lookups import attach_keys, left_lookup
from ..operators.shape import add_row_hash, cast_columns, copy_columns, rename_select


@dataclass(frozen=True)
class Dimension:
    """One dimension: natural keys, types, and the columns its hash key is made of, in order."""

    key: str
    natural: Mapping[str, str]
    hashed: tuple[str, ...]
    types: Mapping[str, str] = field(default_factory=dict)

    def build(self, df: DataFrame) -> DataFrame:
        return self.with_key(df).select(self.key, *self.hashed)

    def with_key(self, df: DataFrame) -> DataFrame:
        """All columns of the source, the natural keys and the hash key."""
        return add_row_hash(cast_columns(copy_columns(df, self.natural), self.types), self.hashed, self.key)


def _packed(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension with its key in the form that shuffles move."""
    return dimension.withColumn(key, packed_hex(key))


def hashed(df: DataFrame, key: str, columns: Sequence[str], *others: str | Column) -> DataFrame:
    """The hash key, other columns, and the columns the key is made of."""
    return add_row_hash(df, columns, key).select(key, *others, *columns)


# Key names, natural keys and hashed columns, which stored keys depend on.
INVESTMENT_DIMENSIONS = {
    "company": Dimension(
        "company_id",
        {"office_id": "office_nk", "object_id": "object_nk"},
        (
            "office_nk", "object_nk", "description", "region", "address1", "address2", "city",
            "zip_code", "state_code", "country_code", "latitude", "longitude",
        ),
        {"latitude": "decimal(9,6)", "longitude": "decimal(9,6)"},
    ),
    "acquisition": Dimension(
        "acquisition_id",
        {
            "acquisition_id": "acquisition_nk",
            "acquiring_object_id": "acquiring_object_nk",
            "acquired_object_id": "acquired_object_nk",
        },
        (
            "acquisition_nk", "acquiring_object_nk", "acquired_object_nk", "term_code",
            "price_amount", "price_currency_code",
        ),
    ),
    "ipos": Dimension(
        "ipos_id",
        {"ipo_id": "ipo_nk"},
        (
            "ipo_nk", "valuation_amount", "valuation_currency_code", "raised_amount",
            "raised_currency_code", "stock_symbol",
        ),
    ),
    "funds": Dimension(
        "funds_id",
        {"fund_id": "fund_nk"},
        ("fund_nk", "name", "raised_amount", "raised_currency_code"),
    ),
    "funding_rounds": Dimension(
        "funding_rounds_id",
        {"funding_round_id": "funding_round_nk"},
        (
            "funding_round_nk", "funding_round_type", "funding_round_code", "raised_amount_usd",
            "raised_amount", "raised_currency_code", "pre_money_valuation_usd", "pre_money_valuation",
            "pre_money_currency_code", "post_money_valuation_usd", "post_money_valuation",
            "post_money_currency_code", "participants", "is_first_round", "is_last_round", "created_by",
        ),
    ),
    "people": Dimension(
        "people_id",
        {"object_id": "people_nk"},
        ("people_nk", "first_name", "last_name", "birthplace", "affiliation_name"),
    ),
    "milestones": Dimension(
        "milestones_id",
        {"milestone_id": "milestone_nk"},
        ("milestone_nk", "description", "milestone_code"),
    ),
}


# Natural-key names, types and hashed columns of the two dimensions that look up others.
INVESTMENT_NAMES = {
    "investment_id": "investment_nk", "funding_round_id": "funding_round_nk",
    "funded_object_id": "funded_object_nk", "investor_object_id": "investor_object_nk",
}
RELATIONSHIP_NAMES = {
    "relationship_id": "relationship_nk",
    "person_object_id": ["people_nk", "person_object_nk"],
    "relationship_object_id": ["object_nk", "relationship_object_nk"],
}
RELATIONSHIP_TYPES = {"start_at": "timestamp_ntz", "end_at": "timestamp_ntz", "is_past": "boolean", "sequence": "int"}
RELATIONSHIP_HASHED = (
    "people_id", "company_id", "relationship_nk", "person_object_nk", "relationship_object_nk",
    "start_at", "end_at", "is_past", "sequence", "title",
)


def investments_dimension(investments: DataFrame, funding_rounds: DataFrame) -> DataFrame:
    """Investments with the key of their funding round; the hash covers the natural keys only.

    It is made after the join, so that the join moves the natural keys alone.
    """
    names = list(INVESTMENT_NAMES.values())
    named = copy_columns(investments, INVESTMENT_NAMES).select(*names)
    found = attach_keys(named, _packed(funding_rounds, "funding_rounds_id"), {"funding_round_nk": "funding_rounds_id"})
    return hashed(found, "investments_id", names, unpacked_hex("funding_rounds_id").alias("funding_rounds_id"))


def relationships_dimension(
    relationships: DataFrame, people: DataFrame, company: DataFrame, one_office: bool = False
) -> DataFrame:
    """Person-company relations with the keys of both sides.

    `company` has one row per office, so a company with several offices repeats the relation;
    `one_office=True` takes one key per company.
    """
    named = cast_columns(copy_columns(relationships, RELATIONSHIP_NAMES), RELATIONSHIP_TYPES)
    with_person = attach_keys(named, _packed(people, "people_id"), {"people_nk": "people_id"})
    with_company = attach_keys(with_person, company, {"object_nk": "company_id"}, dedupe=one_office)
    read = with_company.withColumn("people_id", unpacked_hex("people_id"))
    return hashed(read, "relationships_id", RELATIONSHIP_HASHED)


def investment_dimensions(sources: Mapping[str, DataFrame], one_office: bool = False) -> dict[str, DataFrame]:
    """All nine dimensions from their source tables."""
    dims = {name: spec.build(sources[name]) for name, spec in INVESTMENT_DIMENSIONS.items()}
    dims["investments"] = investments_dimension(sources["investments"], dims["funding_rounds"])
    dims["relationships"] = relationships_dimension(
        sources["relationships"], dims["people"], dims["company"], one_office
    )
    return dims


def _keyed(df: DataFrame, key: str, natural: str) -> DataFrame:
    return df.select(surrogate_key(natural).alias(key), "*")


def keys_only(df: DataFrame, natural: str, name: str) -> DataFrame:
    """sk_<name>_id and nk_<name>_id of a source: what a fact needs of its dimension, without the dimension's joins."""
    return df.select(surrogate_key(natural).alias(f"sk_{name}_id"), F.col(natural).alias(f"nk_{name}_id"))


def address_dimension(address: DataFrame, country: DataFrame) -> DataFrame:
    base = rename_select(address, {
        "nk_address_id": "address_id", "street_name": "street_name", "city": "city", "_country": "country_id",
    })
    joined = left_lookup(base, country, {"country_id": "_country"},
                         {"nk_country_id": "country_id", "country_name": "country_name"}).drop("_country")
    return _keyed(joined, "sk_address_id", "nk_address_id")


def author_dimension(author: DataFrame) -> DataFrame:
    return _keyed(
        rename_select(author, {"nk_author_id": "author_id", "author_name": "author_name"}),
        "sk_author_id", "nk_author_id",
    )


def book_dimension(book: DataFrame, publisher: DataFrame, language: DataFrame) -> DataFrame:
    base = rename_select(book, {
        "nk_book_id": "book_id", "title": "title", "isbn13": "isbn13", "nk_language_id": "language_id",
        "num_pages": "num_pages", "publication_date": "publication_date", "nk_publisher_id": "publisher_id",
    })
    with_publisher = left_lookup(base, publisher, {"publisher_id": "nk_publisher_id"}, {"publisher_name": "publisher_name"})
    joined = left_lookup(with_publisher, language, {"language_id": "nk_language_id"},
                         {"language_code": "language_code", "language_name": "language_name"})
    return _keyed(joined, "sk_book_id", "nk_book_id")


def customer_dimension(customer: DataFrame) -> DataFrame:
    names = {"nk_customer_id": "customer_id", "first_name": "first_name", "last_name": "last_name", "email": "email"}
    return _keyed(rename_select(customer, names), "sk_customer_id", "nk_customer_id")


def author_bridge(book_author: DataFrame) -> DataFrame:
    """Key pairs of books and authors."""
    return book_author.select(
        surrogate_key("author_id").alias("sk_author_id"),
        surrogate_key("book_id").alias("sk_book_id"),
        F.col("author_id").alias("nk_author_id"),
        F.col("book_id").alias("nk_book_id"),
    )


def event_type_table(labels: DataFrame, label: str) -> DataFrame:
    """Code table of event types: SHA-256 id and label, one row per label."""
    return (
        labels.select(F.col(label).alias("event_type")).distinct()
        .select(F.sha2("event_type", 256).alias("event_type_id"), "event_type")
    )


def with_natural_keys(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The source columns under their natural-key names as well."""
    return copy_columns(df, names)
