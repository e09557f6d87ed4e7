"""Quantity per vehicle (QPV), current purchase price and cost per vehicle (CPV).

Plan shape::

    recent BOM explosions -> distinct part numbers ⟕ part ⟕ preferred supplier     (required parts)
      ⟕ current price per part number:
            open-PO prices  ▷ (anti) parts with date-based pricing
            ∪ date-based prices: latest pricing row per (part, supplier) ⋈ open type-9 lines
            -> latest candidate per part number
      ⟕ BOM usage of the newest explosion (summed per sample/part/usage type)
      ⟕ unit divisor, buyer/manager
      -> distinct report rows, CPV = price × rate × quantity per vehicle

Two rewrites keep the plan linear in the data where the original joins are
many-to-many: the exclusion list is an intersection of three part sets
(semi joins of de-duplicated part ids) instead of pricing ⋈ PO lines ⋈ POs;
and the date-based price of a PO line is found by first reducing the pricing
table to its latest row per (part, supplier) — the only rows the per-line
ranking can pick — and then joining lines to that one row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.config import Config
from capstan.functions.dates import calendar_cutoff, elapsed_cutoff, previous_month_end
from capstan.functions.labels import flag_is_null_or_zero, ts_lit
from capstan.operators.joins import join_splittable
from capstan.operators.latest import latest_per_key
from capstan.operators.units import with_unit_divisor
from capstan.session import stored_table
from capstan.sources import Sources
from capstan.sources.layout import EXPLOSION_DAY

PRICE_COLUMNS = ["PurchaseOrderTypeID", "PurchaseOrderLineID", "PartNumber", "UnitPrice", "CurrencyCode",
                 "CurrencyName", "ExchangeRate", "POLCreateDate", "POCreateDate", "PurchaseUnitID", "StockUnitID",
                 "PartID", "SupplierCode", "SupplierName"]

CURRENT_PRICE_COLUMNS = ["PartNumber", "PurchaseOrderTypeID", "SupplierCode", "SupplierName", "UnitPrice",
                         "CurrencyCode", "CurrencyName", "ExchangeRate", "PurchaseUnitID", "StockUnitID", "PartID"]

REQUIRED_PART_COLUMNS = ["DetailPartNumber", "PartDescription", "PartID", "PartSystem", "BuyerCode", "FabricatedFlag",
               "PurchasedFlag", "SubContractFlag", "PreferredSupplierCode", "PreferredSupplierName"]

QPV_COLUMNS = ["PartNumber", "QPVPartDescription", "PartID", "PartSystem", "SupplierCode", "QPVSupplierName",
               "Buyer", "Manager", "POType", "PurchaseUnitID", "StockUnitID", "UnitPrice", "ExchangeRate",
               "PartQuantityPerVehicle", "CPV", "FabricatedFlag", "NonFabricated"]


# ------------------------------------------------------------------ BOM side
def _explosions_since(src: Sources, since: dt.datetime, strictly: bool) -> DataFrame:
    """BOM explosions from ``since`` on.  A table stored by day (``layout.store_by_day``) is read from that day's folder on."""
    e = src["erp_bom_explosion"]
    if EXPLOSION_DAY in e.columns:
        e = e.where(F.col(EXPLOSION_DAY) >= F.lit(since.date()))
    date = F.col("BOMExplosionDate")
    return e.where(date > ts_lit(since) if strictly else date >= ts_lit(since))


def recent_bom_parts(src: Sources, cfg: Config) -> DataFrame:
    """Part numbers exploded within the last ``recent_days`` (elapsed time) with part data."""
    as_of = cfg.as_of_ts()
    be = _explosions_since(src, elapsed_cutoff(as_of, cfg.recent_days), strictly=True)
    pn = be.select("DetailPartNumber").distinct()
    p = src["erp_part"].select(F.col("PartNumber").alias("__pn"), F.col("Description").alias("PartDescription"),
                               "PartID", "PartSystem", "BuyerCode", "FabricatedFlag", "PurchasedFlag",
                               "SubContractFlag", "PreferredSupplierID")
    s2 = src["erp_supplier"].select(F.col("SupplierID").alias("__sid"),
                                    F.col("SupplierCode").alias("PreferredSupplierCode"),
                                    F.col("Name").alias("PreferredSupplierName"))
    required = (pn.join(p, F.col("DetailPartNumber") == F.col("__pn"), "left")
                .join(s2, F.col("PreferredSupplierID") == F.col("__sid"), "left"))
    return required.select(*REQUIRED_PART_COLUMNS)


def bom_usage_latest(src: Sources, cfg: Config) -> DataFrame:
    """Summed running quantity per (sample, part, usage type) of the newest explosion.

    Only an explosion within the last ``recent_days`` (calendar days) counts, so the newest
    one is looked for among those: the same rows, and the history before them is not read.
    Over a table stored by day the newest day prunes the folders once it is known.
    """
    e = _explosions_since(src, calendar_cutoff(cfg.as_of_ts(), cfg.recent_days), strictly=False)
    newest = e.select(F.max("BOMExplosionDate")).scalar()
    if EXPLOSION_DAY in e.columns:
        e = e.where(F.col(EXPLOSION_DAY) == e.select(F.max(EXPLOSION_DAY)).scalar())
    e = e.where(F.col("BOMExplosionDate") == newest)
    samples = (src["erp_bom_sample"].where(F.col("CreateDate") >= ts_lit(cfg.sample_cutoff))
          .select("SalesBOMSampleID", "Name"))
    u = (e.join(samples, "SalesBOMSampleID", "inner")
         .groupBy("SalesBOMSampleID", "BOMExplosionDate", "Name", "DetailPartNumber", "UsageType")
         .agg(F.sum("RunningQuantity").cast("double").alias("Quantity")))     # exact decimal sum
    return u.select("Name", "DetailPartNumber", "UsageType", "Quantity")


# -------------------------------------------------------------- price side
def _po_lines(src: Sources, po_filter, line_filter) -> DataFrame:
    po = (src["erp_po"].where(po_filter)
          .select("PurchaseOrderID", "PurchaseOrderTypeID", "Status", F.col("SupplierID").alias("POSupplierID"),
                  F.col("CurrencyID").alias("POCurrencyID"), F.col("CreateDate").alias("POCreateDate")))
    pol = (src["erp_po_line"].where(line_filter)
           .select("PurchaseOrderID", "PurchaseOrderLineID", F.col("PartID").alias("LinePartID"), "UnitPrice",
                   "PurchaseUnitID", "LineStatus", F.col("CreateDate").alias("POLCreateDate")))
    return pol.join(po, "PurchaseOrderID", "inner")


def price_lines(src: Sources, cfg: Config) -> DataFrame:
    """PO lines joined to their PO, kept if either price rule can read them.

    The filter is the union of the open-price rule and the date-price rule;
    each rule re-applies its own filter on top.  Functions that need several
    rules store this join, with the part columns, once (``shared_lines``), so
    the line and part tables are scanned and shuffled once, whatever number of
    rules reads it.
    """
    statuses = sorted(set(cfg.open_po_statuses) | {cfg.date_priced_po_status})
    types = sorted(set(cfg.price_po_types) | {cfg.date_priced_po_type})
    line_statuses = sorted(set(cfg.open_line_statuses) | {cfg.date_priced_line_status})
    return _po_lines(src, F.col("Status").isin(*statuses) & F.col("PurchaseOrderTypeID").isin(*types),
                     flag_is_null_or_zero(F.col("DeliveryCompleteFlag")) & flag_is_null_or_zero(F.col("ReturnFlag"))
                     & F.col("LineStatus").isin(*line_statuses))


def with_parts(src: Sources, lines: DataFrame) -> DataFrame:
    """``lines`` with PartID, PartNumber and StockUnitID of their part (NULL where the ERP has no such part); lines that have them stay."""
    if "PartNumber" in lines.columns:
        return lines
    parts = src["erp_part"].select(F.col("PartID").alias("LinePartID"), "PartID", "PartNumber", "StockUnitID")
    return join_splittable(lines, parts, ["LinePartID"], "left", spread_nulls_by=["PurchaseOrderLineID"])


def shared_lines(src: Sources, cfg: Config) -> DataFrame:
    """``price_lines`` with their parts, stored once in the shared checkpoint folder (an eager step)."""
    return stored_table(with_parts(src, price_lines(src, cfg).drop("PurchaseOrderID")), "price-lines")


def _open_rule(cfg: Config):
    return (F.col("Status").isin(*cfg.open_po_statuses) & F.col("PurchaseOrderTypeID").isin(*cfg.price_po_types)
            & F.col("LineStatus").isin(*cfg.open_line_statuses) & (F.col("UnitPrice") != 0))


def _date_rule(cfg: Config, nonzero_price: bool):
    rule = ((F.col("Status") == cfg.date_priced_po_status)
            & (F.col("PurchaseOrderTypeID") == cfg.date_priced_po_type)
            & (F.col("LineStatus") == cfg.date_priced_line_status))
    return rule & (F.col("UnitPrice") != 0) if nonzero_price else rule


def open_po_prices(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Priced lines of open/closed POs of the price-relevant types."""
    lines = with_parts(src, (price_lines(src, cfg) if lines is None else lines).where(_open_rule(cfg)))
    s = src["erp_supplier"].select(F.col("SupplierID").alias("__sid"), "SupplierCode",
                                   F.col("Name").alias("SupplierName"))
    c = src["erp_currency"].select(F.col("CurrencyID").alias("__cid"), "CurrencyCode",
                                   F.col("Name").alias("CurrencyName"), "ExchangeRate")
    x = (lines.join(s, F.col("POSupplierID") == F.col("__sid"), "left")
         .join(c, F.col("POCurrencyID") == F.col("__cid"), "left"))
    return x.select(*[F.col(k).cast("double").alias(k) if k == "UnitPrice" else F.col(k) for k in PRICE_COLUMNS])


def date_priced_parts(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Parts with a pricing row starting on/before the cut-off and an open type-9 line."""
    lines = price_lines(src, cfg) if lines is None else lines
    lines = with_parts(src, lines.where(_date_rule(cfg, nonzero_price=False)))
    line_parts = lines.where(F.col("PartID").isNotNull()).select("PartID").distinct()
    # de-duplicated before the semi join: a hot part is one row of the right side
    priced = (src["erp_date_pricing"].where(F.col("StartDate") <= ts_lit(cfg.date_pricing_cutoff))
              .select("PartID").distinct())
    return line_parts.join(priced, "PartID", "left_semi")


def non_date_priced(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Open-PO prices of parts without date-based pricing (rows with NULL part kept)."""
    lines = shared_lines(src, cfg) if lines is None else lines
    # before the names of supplier and currency are joined: fewer and narrower rows travel
    kept = join_splittable(with_parts(src, lines.where(_open_rule(cfg))), date_priced_parts(src, cfg, lines), ["PartID"], "left_anti",
                           spread_nulls_by=["PurchaseOrderLineID"])
    return open_po_prices(src, cfg, kept)


def month_end_fx(src: Sources, cfg: Config) -> DataFrame:
    """Month-end rates valid on the last day of the month before ``as_of``."""
    return (src["erp_fx_map"].where((F.col("ExchangeRateType") == cfg.rate_type)
                                    & (F.col("ValidFrom") == ts_lit(previous_month_end(cfg.as_of_ts()))))
            .select("FromCurrencyID", "ToCurrencyID", "ExchangeRate"))


def date_based_prices(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Price of each open type-9 line from the latest pricing row of its (part, PO supplier) before the cut-off.

    Price in PO currency and purchase unit: pricing price × rate (1 for the
    same currency, else the month-end rate or 1), divided by the forward or
    multiplied by the reverse part-specific unit factor.
    """
    cfg = cfg.fixed()
    pricing = src["erp_date_pricing"].where(F.col("StartDate") < ts_lit(cfg.date_pricing_cutoff))
    latest = latest_per_key(pricing, ["PartID", "SupplierID"],
                            [F.col("StartDate").desc_nulls_last(), F.col("PartSupplierDatePricingID").desc()])
    latest = latest.select(F.col("PartID").alias("LinePartID"), F.col("SupplierID").alias("POSupplierID"),
                           F.col("CurrencyID").alias("PricingCurrencyID"),
                           F.col("UnitPrice").cast("double").alias("PricingPrice"))
    lines = with_parts(src, (price_lines(src, cfg) if lines is None else lines).where(_date_rule(cfg, nonzero_price=True)))
    lines = lines.where(F.col("PartID").isNotNull())
    suppliers = src["erp_supplier"].select(F.col("SupplierID").alias("POSupplierID"), "SupplierCode",
                                           F.col("Name").alias("SupplierName"))
    units = src["erp_unit"].select("UnitID")
    currencies = src["erp_currency"].select(F.col("CurrencyID").alias("POCurrencyID"), "CurrencyCode",
                                            F.col("Name").alias("CurrencyName"))
    part_conv = src["erp_part_unit_conv"]
    # One price per PO line: the original ranks a line's rows after all joins.  The lookups that can hold
    # several rows per key are reduced first (largest rate, largest factor), so no line is ever multiplied.
    factors = (part_conv.groupBy("PartID", "FromUnitID", "ToUnitID")
               .agg(F.max(F.col("ConversionFactor").cast("double")).alias("factor")))
    conv_fwd = factors.select(F.col("PartID").alias("__fp"), F.col("FromUnitID").alias("__ff"),
                              F.col("ToUnitID").alias("__ft"), F.col("factor").alias("CF1"))
    conv_rev = factors.select(F.col("PartID").alias("__rp"), F.col("FromUnitID").alias("__rf"),
                              F.col("ToUnitID").alias("__rt"), F.col("factor").alias("CF2"))
    rates = (month_end_fx(src, cfg).groupBy(F.col("FromCurrencyID").alias("__xf"), F.col("ToCurrencyID").alias("__xt"))
             .agg(F.max("ExchangeRate").alias("__rate")))
    x = (join_splittable(lines, latest, ["LinePartID", "POSupplierID"], "inner")
         .join(suppliers, "POSupplierID", "inner")
         .join(units, F.col("StockUnitID") == F.col("UnitID"), "left_semi")
         .join(units, F.col("PurchaseUnitID") == F.col("UnitID"), "left_semi")
         .join(currencies, "POCurrencyID", "inner")
         .join(conv_fwd, (F.col("__ff") == F.col("StockUnitID")) & (F.col("__ft") == F.col("PurchaseUnitID"))
               & (F.col("__fp") == F.col("LinePartID")), "left")
         .join(conv_rev, (F.col("__rt") == F.col("StockUnitID")) & (F.col("__rf") == F.col("PurchaseUnitID"))
               & (F.col("__rp") == F.col("LinePartID")), "left")
         .join(rates, (F.col("__xf") == F.col("PricingCurrencyID")) & (F.col("__xt") == F.col("POCurrencyID")), "left"))
    rate = F.when(F.col("PricingCurrencyID") == F.col("POCurrencyID"), F.lit(1.0)) \
        .otherwise(F.coalesce(F.col("__rate"), F.lit(1.0)))
    base = F.col("PricingPrice") * F.col("ExchangeRate")
    price = (F.when(F.col("CF1").isNull() & F.col("CF2").isNull(), base)
             .when(F.col("CF1").isNotNull(), base / F.col("CF1"))
             .when(F.col("CF2").isNotNull(), base * F.col("CF2")))
    x = x.withColumn("ExchangeRate", rate).withColumn("UnitPrice", price)
    return x.select(*PRICE_COLUMNS)


def price_candidates(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Open-PO prices (without date-priced parts) followed by date-based prices."""
    lines = shared_lines(src, cfg) if lines is None else lines
    return non_date_priced(src, cfg, lines).unionByName(date_based_prices(src, cfg, lines))


def current_price(src: Sources, cfg: Config, lines: DataFrame | None = None) -> DataFrame:
    """Latest price candidate per part number (PO date, then line date, then line id)."""
    latest = latest_per_key(price_candidates(src, cfg, lines), ["PartNumber"],
                            [F.col("POCreateDate").desc_nulls_last(), F.col("POLCreateDate").desc_nulls_last(),
                             F.col("PurchaseOrderLineID").desc()])
    return latest.select(*CURRENT_PRICE_COLUMNS)


def unit_conversion(src: Sources, cfg: Config) -> DataFrame:
    """Current price rows with the stock-to-purchase unit divisor."""
    cp = current_price(src, cfg).select("PartNumber", "PartID", "StockUnitID", "PurchaseUnitID")
    return with_unit_divisor(cp, src["erp_unit_conv"], src["erp_part_unit_conv"])


# ------------------------------------------------------------------ report
def qpv_data(src: Sources, cfg: Config) -> DataFrame:
    """QPV/CPV report: one row per required part × usage line (distinct)."""
    cfg = cfg.fixed()
    required = recent_bom_parts(src, cfg)
    price = current_price(src, cfg)
    price = price.select(*[F.col(c).alias("price_" + c) for c in price.columns])
    usage = bom_usage_latest(src, cfg).select(F.col("DetailPartNumber").alias("__upn"), "Quantity")
    buyers = src["erp_buyer_mgr"].select(F.col("BuyerCode").alias("__bc"), "Buyer", "Manager")
    # The divisor is evaluated on the joined row: a part without a current
    # price has no purchase unit, hence divisor 1 (quantity passes through).
    priced = with_unit_divisor(required.join(price, F.col("DetailPartNumber") == F.col("price_PartNumber"), "left"),
                               src["erp_unit_conv"], src["erp_part_unit_conv"], part="price_PartID",
                               stock="price_StockUnitID", purchase="price_PurchaseUnitID", out="price_UnitDivisor")
    rows = (priced.join(usage, F.col("__upn") == F.col("DetailPartNumber"), "left")
            .join(buyers, F.col("BuyerCode") == F.col("__bc"), "left"))
    qpv = F.coalesce(F.col("Quantity") / F.col("price_UnitDivisor"), F.lit(0.0))
    rate = F.coalesce(F.col("price_ExchangeRate"), F.lit(1.0))
    out = rows.select(
        F.col("DetailPartNumber").alias("PartNumber"),
        F.col("PartDescription").alias("QPVPartDescription"),
        "PartID", "PartSystem",
        F.coalesce("price_SupplierCode", "PreferredSupplierCode").alias("SupplierCode"),
        F.coalesce("price_SupplierName", "PreferredSupplierName").alias("QPVSupplierName"),
        "Buyer", "Manager",
        F.col("price_PurchaseOrderTypeID").alias("POType"),
        F.col("price_PurchaseUnitID").alias("PurchaseUnitID"),
        F.col("price_StockUnitID").alias("StockUnitID"),
        F.col("price_UnitPrice").alias("UnitPrice"),
        rate.alias("ExchangeRate"),
        qpv.alias("PartQuantityPerVehicle"),
        (F.col("price_UnitPrice") * rate * qpv).alias("CPV"),
        "FabricatedFlag",
        F.coalesce("PurchasedFlag", "SubContractFlag").alias("NonFabricated"),
    )
    return out.distinct()
