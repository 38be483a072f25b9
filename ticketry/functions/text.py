"""Ticket text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: replacement rules, applied in this order ------------------------------
# Letters, digits and '_' are taken in their Unicode sense.
TEMPLATE_RULES = (
    (r"IC\p{Nd}+", "<ID>"),
    (r"[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+", "<EMAIL>"),
    (r"(?U)\b(?:[a-zA-Z0-9-]+\.)+[a-zA-Z]{2,}\b", "<DOMINIO>"),
    (r"\p{Nd}+", "<NUM>"),
)
# The address rule as it runs: the same matches, but a run of letters without '@' is read once.
ADDRESS = r"(?<![\p{L}\p{N}_.-])[\p{L}\p{N}_.-]++@[\p{L}\p{N}_.-]++"
ITEM_ID = r"IC\p{Nd}+"
WORD = r"(?U)\b\w\w+\b"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_template(c: str | Column) -> Column:
    """Text with ids, addresses, domains and numbers replaced by placeholders; NULL stays."""
    out = _col(c)
    for pattern, label in TEMPLATE_RULES:
        out = F.regexp_replace(out, ADDRESS if label == "<EMAIL>" else pattern, label)
    return out


def hide_item_ids(c: str | Column, label: str = "<IC>") -> Column:
    return F.regexp_replace(_col(c), ITEM_ID, label)


def item_tokens(c: str | Column) -> Column:
    """'TOKEN_IC1 TOKEN_IC2' for every item id in the text, '' when there is none."""
    found = F.regexp_extract_all(_col(c), F.lit(ITEM_ID), F.lit(0))
    named = F.transform(found, lambda x: F.concat(F.lit("TOKEN_"), x))
    return F.coalesce(F.array_join(named, " "), F.lit(""))


def template_with_items(c: str | Column) -> Column:
    return F.trim(F.concat(F.coalesce(as_template(c), F.lit("")), F.lit(" "), item_tokens(c)))


def before_colon(c: str | Column) -> Column:
    return F.split_part(_col(c), F.lit(":"), F.lit(1))
