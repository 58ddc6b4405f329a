"""Units of measure: packaging-string parse (P7), conversion map (C7),
validation (J16) and alternative-UOM order quantities (C8).

The conversion map is built from *distinct* conversion tuples, so repeating a
vendor item on many feed lines does not multiply its conversions. Alternatives
are keyed by the review row's own (vendor_item, default_buy_uom,
buy_uom_multiplier); the per-key group size is bounded by the number of
packaging levels of one item, not by data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shortfall.functions import ceil_double, ieee_div, remove_token

# Fixed value: "<number> <UOM>/<UOM>" inside a packaging string.
PACKAGING_PATTERN = r"(\d+(?:\.\d+)?)\s+([A-Z]+)/([A-Z]+)"
UOM_KEY = ("vendor_item", "default_buy_uom", "buy_uom_multiplier")
ALTERNATIVE_COLUMNS = ("alt_uom_group", "to_uom", "from_uom", "conv_factor")


def parse_packaging(df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per ``<n> <UOM>/<UOM>`` match, in match order (``pos``).

    A NULL or empty string yields one blank row ('', '', NULL factor); a
    non-empty string without a match yields no row. Matching is case-sensitive.
    """
    s = F.col("packaging_string")
    amounts = F.regexp_extract_all(s, F.lit(PACKAGING_PATTERN), 1)
    uoms = F.regexp_extract_all(s, F.lit(PACKAGING_PATTERN), 2)
    tos = F.regexp_extract_all(s, F.lit(PACKAGING_PATTERN), 3)
    # zipped, so that the string is searched once for each part, not once for each match
    matches = F.transform(
        F.arrays_zip(tos.alias("to"), uoms.alias("of"), amounts.alias("n")),
        lambda m: F.struct(m["to"].alias("convert_to_uom"), m["of"].alias("uom"), m["n"].cast("double").alias("conv_factor")))
    blank = F.array(F.struct(F.lit("").alias("convert_to_uom"), F.lit("").alias("uom"),
                             F.lit(None).cast("double").alias("conv_factor")))
    arr = F.when(s.isNull() | (s == ""), blank).otherwise(matches)
    out = df.select(*carry, "vendor_item", F.posexplode(arr).alias("pos", "m"))
    return out.select(*carry, "vendor_item", "pos", "m.convert_to_uom", "m.uom", "m.conv_factor")


def conversion_tuples(parsed: DataFrame) -> DataFrame:
    """Distinct (vendor_item, base_uom, uom, conv_factor) tuples -- base
    'CS' -> 'CA', blank factor -> 0.0, blank base and NULL item dropped. The
    result is small (one row per packaging level of an item) whatever the
    number of feed lines."""
    base = F.when(F.col("convert_to_uom") == "CS", F.lit("CA")).otherwise(F.col("convert_to_uom"))
    return parsed.select(
        "vendor_item", base.alias("base_uom"), "uom",
        F.coalesce(F.col("conv_factor"), F.lit(0.0)).alias("conv_factor"),
    ).filter((F.col("base_uom") != "") & F.col("vendor_item").isNotNull()).distinct()


def build_conversions(parsed: DataFrame | None = None, tuples: DataFrame | None = None) -> DataFrame:
    """Conversion map (vendor_item, conv_factor, base_uom, to_uom, from_uom).

    From parsed packaging rows (or their ``conversion_tuples``): A8 joins the
    UOMs per (item, factor, base); J14 derives multi-level factors (small /
    bulk within one base); E2 + U2 expand and union; A9 lists the bases per
    (item, factor, to_uom); J15 attaches it. Lists are sorted alphabetically
    and hold distinct values.
    """
    uom = tuples if tuples is not None else conversion_tuples(parsed)
    uom_t = uom.groupBy("vendor_item", "conv_factor", "base_uom").agg(
        F.array_join(F.array_sort(F.collect_set("uom")), ",").alias("to_uom"))
    bulk = uom_t.alias("b")
    small = uom_t.alias("s")
    derived = bulk.join(
        small,
        (F.col("b.vendor_item") == F.col("s.vendor_item")) & (F.col("b.base_uom") == F.col("s.base_uom"))
        & (F.col("s.conv_factor") > F.col("b.conv_factor")),
    ).select(
        F.col("b.vendor_item").alias("vendor_item"),
        ieee_div(F.col("s.conv_factor"), F.col("b.conv_factor")).alias("conv_factor"),
        F.explode(F.split(F.col("b.to_uom"), ",")).alias("base_uom"),
        F.col("s.to_uom").alias("to_uom"),
    )
    extended = uom_t.select("vendor_item", "conv_factor", "base_uom", "to_uom") \
        .unionByName(derived).distinct()
    # A9 + J15 in one pass: the base list of each (item, factor, to_uom) is a
    # window over that key (a handful of packaging levels, never data-sized)
    key = Window.partitionBy("vendor_item", "conv_factor", "to_uom")
    return extended.select(
        "vendor_item", "conv_factor", "base_uom", "to_uom",
        F.array_join(F.array_sort(F.collect_set("base_uom").over(key)), ",").alias("from_uom"))


def unresolved_uom(review: DataFrame, conversions: DataFrame) -> DataFrame:
    """Vendor items of review rows whose own (multiplier, default buy UOM)
    has no conversion entry."""
    conv = conversions.select(
        F.col("vendor_item").alias("_v"), F.col("conv_factor").alias("_f"),
        F.col("base_uom").alias("_b"))
    cond = review["vendor_item"].eqNullSafe(conv["_v"]) & \
        review["buy_uom_multiplier"].eqNullSafe(conv["_f"]) & \
        review["default_buy_uom"].eqNullSafe(conv["_b"])
    return review.join(conv, cond, "left_anti").select("vendor_item").distinct()


def alternative_table(review: DataFrame, conversions: DataFrame) -> DataFrame:
    """Alternatives per UOM key (vendor_item, default_buy_uom, buy_uom_multiplier).

    Same-UOM rows: conversions whose base and factor equal the key's default
    UOM and multiplier (NULL never equal). For each same-UOM ``to_uom``, the
    other conversions of the item with that ``to_uom`` are the alternatives;
    ``from_uom`` loses the default UOM (P20). Numbered 'Group k' per key (W3),
    even when there is no alternative.
    """
    keys = review.select(*UOM_KEY).distinct()
    prep = keys.join(conversions, "vendor_item")
    same_cond = F.coalesce(
        (F.col("default_buy_uom") == F.col("base_uom")) & (F.col("buy_uom_multiplier") == F.col("conv_factor")),
        F.lit(False))
    same = prep.filter(same_cond).select(*UOM_KEY, "to_uom").distinct()
    alt = prep.filter(~same_cond).select(
        *[F.col(k).alias(f"_{k}") for k in UOM_KEY], F.col("to_uom").alias("_to"),
        F.col("from_uom").alias("_from"), F.col("conv_factor").alias("_cf")).distinct()
    cond = None
    for k in UOM_KEY:
        c = same[k].eqNullSafe(alt[f"_{k}"])
        cond = c if cond is None else cond & c
    cond = cond & (same["to_uom"] == alt["_to"])
    joined = same.join(alt, cond, "left").select(
        *UOM_KEY, "to_uom", remove_token(F.col("_from"), F.col("default_buy_uom")).alias("from_uom"),
        F.col("_cf").alias("conv_factor"))
    w = Window.partitionBy(*UOM_KEY).orderBy(
        F.col("to_uom").asc_nulls_first(), F.col("conv_factor").asc_nulls_first(),
        F.col("from_uom").asc_nulls_first())
    return joined.withColumn("alt_uom_group", F.concat(F.lit("Group "), F.row_number().over(w).cast("string")))


def attach_alternatives(rows: DataFrame, alt_table: DataFrame, condition=None) -> DataFrame:
    """LEFT JOIN rows to their alternatives on the UOM key (NULL-safe) and
    compute the order quantity in the alternative UOM (P21)."""
    r = alt_table.select(*[F.col(k).alias(f"_a_{k}") for k in UOM_KEY],
                         "alt_uom_group", "to_uom", "from_uom", "conv_factor")
    rest = None
    if condition is not None:
        # rows that cannot match do not travel to the join (most share one NULL key)
        wanted = F.coalesce(condition, F.lit(False))
        rows, rest = rows.filter(wanted), rows.filter(~wanted)
    cond = None
    for k in UOM_KEY:
        c = rows[k].eqNullSafe(r[f"_a_{k}"])
        cond = c if cond is None else cond & c
    out = rows.join(r, cond, "left").drop(*[f"_a_{k}" for k in UOM_KEY])
    if rest is not None:
        types = {f.name: f.dataType for f in out.schema}
        out = out.unionByName(rest.withColumns({c: F.lit(None).cast(types[c]) for c in ("alt_uom_group", "to_uom", "from_uom", "conv_factor")}))
    return alternative_quantity(out)


def unfold_alternatives(rows: DataFrame, condition=None) -> DataFrame:
    """Rows with their alternatives taken from the array ``alts`` (of rows that meet ``condition``) and the order
    quantity in the alternative UOM (P21); without alternatives a row stays with NULLs."""
    alts = F.col("alts") if condition is None else F.when(condition, F.col("alts"))
    out = rows.withColumn("_alt", F.explode_outer(alts)).drop("alts")
    return alternative_quantity(out.withColumns({c: F.col(f"_alt.{c}") for c in ALTERNATIVE_COLUMNS}).drop("_alt"))


def alternative_quantity(df: DataFrame) -> DataFrame:
    """The order quantity in the alternative unit, rounded up."""
    out = df.withColumn("_per_alt", ieee_div("rec_qty_ea", "conv_factor"))
    return out.withColumn("rec_qty_alt_uom", ceil_double("_per_alt")).drop("_per_alt")


# The alternative table's columns.
REVIEW_ALT_COLUMNS = (
    "vendor_item", "item", "replace_item", "alt_uom_group", "conv_factor",
    "rec_qty_buy_uom", "rec_qty_buy_uom_repl", "rec_qty_ea", "rec_qty_alt_uom",
    "target_coverage", "target_coverage_ig", "target_qty_ea", "target_qty_ea_ig",
    "from_uom", "to_uom",
)


def uom_alternatives(review: DataFrame, conversions: DataFrame) -> DataFrame:
    """Review rows with their alternative-UOM order quantities."""
    alts = alternative_table(review, conversions)
    return attach_alternatives(review, alts).select(*REVIEW_ALT_COLUMNS)

