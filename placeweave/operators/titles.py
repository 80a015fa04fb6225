"""Titles: changes between extracts, categories, and one row per property."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.boilerplate import clean_boilerplate, clean_spelling, tidy
from ..functions.keys import POSTCODE, count_postcodes, first_postcode, is_substation, squish
from ..functions.numbers import split_numbers_udf
from .relational import first_per_key, union_all

TITLE, ADDRESS = "Title Number", "Property Address"
SHORT = 54


def diff_titles(new: DataFrame, old: DataFrame) -> DataFrame:
    """``new`` with diff_status: new, unchanged or changed against ``old`` (first address per title)."""
    before = old.select(F.col(f"`{TITLE}`"), F.col(f"`{ADDRESS}`").alias("__old"))
    before = first_per_key(before, [TITLE], F.col("__old").asc_nulls_last())
    joined = new.join(before, TITLE, "left")
    status = (
        F.when(F.col("__old").isNull(), "new")
        .when(F.col(f"`{ADDRESS}`") == F.col("__old"), "unchanged")
        .otherwise("changed")
    )
    return joined.withColumn("diff_status", status).drop("__old")


def _address() -> Column:
    return F.col(f"`{ADDRESS}`")


def categorise_freehold(titles: DataFrame) -> DataFrame:
    """Freehold titles with n_postcode, land, category and AddressLine (only for the simple categories)."""
    rows = titles.filter((F.col("Tenure") == "Freehold") & _address().isNotNull())
    rows = rows.withColumns({"n_postcode": count_postcodes(_address()), "land": _address().rlike(r"(?i)\bland\b")})
    bare = F.replace(F.replace(_address(), F.col("Postcode"), F.lit("")), F.lit("()"), F.lit(""))
    category = (
        F.when(F.col("Postcode").isNull(), F.when(F.col("land"), "nopc_land").otherwise("nopc"))
        .when(F.col("land"), "land_pc")
        .when(F.col("n_postcode") >= 2, "multi_postcode")
        .when(F.length(bare) > SHORT, "simple_long")
        .otherwise("simple_short")
    )
    rows = rows.withColumn("category", category)
    line = F.when(F.col("category").isin("simple_short", "simple_long"), bare)
    return rows.withColumns({"AddressLine": line, "dataset": F.lit("ccod_freehold")})


def categorise_leasehold(titles: DataFrame) -> DataFrame:
    rows = titles.filter((F.col("Tenure") == "Leasehold") & _address().isNotNull())
    return rows.withColumns({"n_postcode": count_postcodes(_address()), "category": F.lit("leasehold"), "dataset": F.lit("ccod_leasehold")})


def categorise_overseas(titles: DataFrame) -> DataFrame:
    rows = titles.filter(_address().isNotNull())
    return rows.withColumns({"n_postcode": count_postcodes(_address()), "category": F.lit("overseas"), "dataset": F.lit("ocod")})


def nopc_kind(address: Column | str) -> Column:
    """substation, other_complex or simple, for titles without a postcode."""
    address = F.col(address) if isinstance(address, str) else address
    complex_ = F.coalesce(address.rlike("(?i)substation|sub-station|sub station|part of"), F.lit(False))
    return F.when(complex_ & is_substation(address), "substation").when(complex_, "other_complex").otherwise("simple")


#: What is left before a piece when a text is cut after a postcode, in this order.
LEFTOVERS = [
    r"^and\s", r"^\s\sand\s", r"^\sand\s", r"^\p{Punct} and\s", r"^\s\p{Punct} and\s", r"^\)\s\p{Punct} and\s",
    r"^\)\p{Punct} ", r"^\p{Punct}\s", r"^\p{Punct}", r"^\s", r"\s\(\)$", r"\s\($",
]


def split_multi_postcode(df: DataFrame, column: str = ADDRESS) -> DataFrame:
    """One row per postcode of a text: cut after each but the last, whose piece runs to the end."""
    mark = "\x01"
    marked = F.regexp_replace(F.col(f"`{column}`"), f"({POSTCODE})", "$1" + mark)
    pieces = F.split(marked, mark)
    n = F.size(pieces)
    # What follows the last postcode belongs to its piece.
    tail = F.concat(F.get(pieces, n - 2), F.get(pieces, n - 1))
    joined = F.when(n <= 1, pieces).otherwise(F.concat(F.slice(pieces, F.lit(1), F.greatest(n - 2, F.lit(0))), F.array(tail)))
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in ("AddressLine", "PostalCode")], F.explode(joined).alias("AddressLine"))
    rows = rows.withColumn("PostalCode", first_postcode("AddressLine"))
    # Only the first postcode of a piece goes (there is one at most, but for a null column).
    line = F.regexp_replace(F.col("AddressLine"), f"(?s)^(.*?){POSTCODE}", "$1")
    for rx in LEFTOVERS:
        line = F.regexp_replace(line, rx, "")
    return rows.withColumn("AddressLine", line)


def split_and_explode(df: DataFrame, column: str = "AddressLine") -> DataFrame:
    """One row per house number; rows that the grammar cannot read drop out."""
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*others, F.explode(split_numbers_udf(F.col(column))).alias(column))


def finish_boilerplate(df: DataFrame, phrases=None, long_phrases=None) -> DataFrame:
    """Texts with boilerplate: cut at postcodes, cleaned, without the postcode, one row per number."""
    multi = F.coalesce(F.col("n_postcode") >= 2, F.lit(False))
    single = df.filter(~multi).withColumns({"AddressLine": _address(), "PostalCode": F.col("Postcode")})
    rows = union_all(single, split_multi_postcode(df.filter(multi)))
    line = clean_boilerplate("AddressLine", long_phrases, phrases)
    line = F.replace(F.regexp_replace(line, POSTCODE, ""), F.lit("()"), F.lit(""))
    return split_and_explode(rows.withColumn("AddressLine", line))


def build_split_addresses(categorised: DataFrame, phrases=None, long_phrases=None) -> DataFrame:
    """Categorised titles (with orig_row_id) as one row per property, with AddressLine_tagged and parse_ok.

    Titles without a postcode that describe a part of something are kept unparsed.
    """
    if "AddressLine" not in categorised.columns:
        categorised = categorised.withColumn("AddressLine", F.lit(None).cast("string"))
    kind = nopc_kind(ADDRESS)
    rows = categorised.withColumn("__kind", F.when(F.col("category") == "nopc", kind))
    rows = rows.withColumn("category", F.when(F.col("__kind") == "substation", "nopc_substation")
                           .when(F.col("__kind") == "other_complex", "nopc_complex").otherwise(F.col("category"))).drop("__kind")
    simple = rows.filter(F.col("category").isin("simple_short", "simple_long"))
    multi = split_multi_postcode(rows.filter("category = 'multi_postcode'"))
    nopc = rows.filter("category = 'nopc'").withColumn("AddressLine", clean_spelling(_address()))
    plain = union_all(simple, multi, nopc).withColumn("PostalCode", F.coalesce("PostalCode", "Postcode"))
    long_ = finish_boilerplate(rows.filter(F.col("category").isin("nopc_land", "nopc_substation")), phrases, long_phrases)
    other = finish_boilerplate(rows.filter(F.col("category").isin("land_pc", "leasehold", "overseas")), phrases)
    out = union_all(split_and_explode(plain), long_, other)
    out = out.withColumn("AddressLine_tagged", F.col("AddressLine")).withColumn("AddressLine", tidy("AddressLine"))
    out = out.filter(F.length("AddressLine") > 0).withColumn("parse_ok", F.lit(True))
    unread = rows.filter("category = 'nopc_complex'").withColumns({"AddressLine": F.lit(None).cast("string"), "parse_ok": F.lit(False)})
    return union_all(out, unread)


def carry_forward(split: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unchanged titles with an earlier result, and all that still needs one."""
    split = split.withColumn("AddressLine", squish(F.col("AddressLine")))
    results = old.select(F.col(f"`{TITLE}`"), F.col("old_address_line").alias("AddressLine"), F.col("old_property_address").alias(ADDRESS),
                         *[c for c in old.columns if c not in (TITLE, "old_address_line", "old_property_address")])
    carried = split.filter("diff_status = 'unchanged'").join(results, [TITLE, "AddressLine", ADDRESS]).withColumn("source", F.lit("carried_forward_2022"))
    done = carried.select(F.col(f"`{TITLE}`"), "AddressLine").distinct()
    changed = split.filter("diff_status <> 'unchanged'")
    left = split.filter("diff_status = 'unchanged'").join(done, [TITLE, "AddressLine"], "left_anti")
    return carried, changed.unionByName(left.select(*[F.col(f"`{c}`") for c in changed.columns]))


def length_tiers(df: DataFrame, column: str = "AddressLine") -> DataFrame:
    """Lengths as the older stages told them apart."""
    n = F.length(F.col(f"`{column}`"))
    return df.withColumn("tier", F.when(n > 150, "very_long").when(n > 90, "long").when(n > SHORT, "medium").otherwise("short"))
