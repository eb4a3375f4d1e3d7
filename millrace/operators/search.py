"""Keyword search over text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def occurrences(text: str | Column, term: str) -> Column:
    """How often a word (letters and digits only) stands in the whole text, in any case.

    The regular expression runs only on texts that contain the letters at all.
    """
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    word = term.lower()
    whole_word = rf"(?<![\p{{L}}\p{{N}}])\Q{word}\E(?![\p{{L}}\p{{N}}])"
    return F.when(F.contains(low, F.lit(word)), F.regexp_count(low, F.lit(whole_word))).otherwise(0)


def keyword_scores(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """Adds `score` (term counts weighted by rarity) and `matched` (different terms found).

    Rarity is ln((1 + rows) / (1 + rows with the term)) + 1, taken over the whole table. Rows
    without any term are left out.
    """
    terms = list(dict.fromkeys(t.lower() for t in terms))
    counted = df.withColumns({f"_t{i}": occurrences(text, t) for i, t in enumerate(terms)})
    # The texts are searched once; what was found is kept for the rarities and for the scores.
    counted = cut_lineage(counted.where(F.greatest(F.lit(0), F.lit(0), *[F.col(f"_t{i}") for i in range(len(terms))]) > 0))
    seen = counted.agg(*[F.count_if(F.col(f"_t{i}") > 0).alias(f"d{i}") for i in range(len(terms))]).first() if terms else None
    total = df.count()
    score, matched = F.lit(0.0), F.lit(0)
    for i in range(len(terms)):
        rarity = F.log(F.lit((total + 1) / (seen[f"d{i}"] + 1))) + 1
        score = score + F.col(f"_t{i}") * rarity
        matched = matched + F.when(F.col(f"_t{i}") > 0, 1).otherwise(0)
    return (
        counted.withColumns({"score": score, "matched": matched})
        .where(F.col("matched") > 0)
        .drop(*[f"_t{i}" for i in range(len(terms))])
    )
