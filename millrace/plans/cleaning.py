"""Cleaning jobs: campaign file, survey table, product catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_from_parts
from ..functions.numbers import outcome_flag, yes_flag
from ..functions.text import feature_text, letters, number_before, path_of, sentinel_to_null, swap, without
from ..operators.shape import keys_in, split_columns

CATALOGUE_ATTRIBUTES = (
    "gender", "masterCategory", "subCategory", "articleType", "baseColour", "season", "year", "usage",
    "productDisplayName",
)


def split_campaign(df: DataFrame, year: int = 2022) -> dict[str, DataFrame]:
    """Client, campaign and economics tables from one marketing file."""
    return split_columns(df, {
        "client": {
            "id": "client_id", "age": "age", "job": without("job", "."), "marital": "marital",
            "education": sentinel_to_null(swap("education", ".", "_")),
            "credit_default": "credit_default", "housing": "housing", "loan": "loan",
        },
        "campaign": {
            "campaign_id": F.lit(1), "client_id": "client_id", "number_contacts": "campaign",
            "contact_duration": "duration", "pdays": "pdays", "previous_campaign_contacts": "previous",
            "previous_outcome": outcome_flag("poutcome"), "campaign_outcome": yes_flag("y"),
            "last_contact_date": date_from_parts(year, "month", "day"),
        },
        "economics": {
            "client_id": "client_id", "emp_var_rate": "emp_var_rate", "cons_price_idx": "cons_price_idx",
            "euribor_three_months": "euribor3m", "number_employed": "nr_employed",
        },
    })


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Text numbers to int; what does not parse gets the rounded mean (half to even)."""
    number = F.col(column).try_cast("double")
    mean = df.agg(F.bround(F.avg(number), 0)).scalar()
    return df.withColumn(column, F.coalesce(number, mean).cast("int"))


def clean_survey(df: DataFrame) -> DataFrame:
    """Month names only, browsers filled, ages imputed, '7/10' scores as numbers."""
    cleaned = df.withColumns({
        "review_month": letters("review_month"),
        "web_browser": F.coalesce("web_browser", F.lit("Unknown")),
        "value_for_money": number_before("value_for_money", "/10"),
    })
    return fill_with_mean(cleaned, "reviewer_age")


def illogical_counts(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Values per column that match a pattern at their start, in one scan."""
    return df.agg(*[F.count_if(F.col(c).rlike(f"^(?:{p})")).alias(c) for c, p in patterns.items()])


def clean_catalogue(
    df: DataFrame, image_ids: DataFrame, folder: str, attributes: Sequence[str] = CATALOGUE_ATTRIBUTES
) -> DataFrame:
    """Blank nulls, tidy years and names, feature text and image path; products with an image only.

    `image_ids` has the product ids as text in the column `id`.
    """
    filled = df.withColumn("id", F.col("id").cast("string")).fillna("", [c for c in attributes if c != "year"])
    tidy = filled.withColumns({
        "year": without(F.coalesce(F.col("year").cast("string"), F.lit("")), ".0"),
        "productDisplayName": without("productDisplayName", "\n"),
        "uri": path_of(folder, "id", ".jpg"),
    })
    return keys_in(tidy.withColumn("text", feature_text(attributes)), image_ids, "id")


def missing_names(df: DataFrame, name: str = "productDisplayName") -> DataFrame:
    return df.where(F.col(name).isNull() | (F.trim(name) == ""))
