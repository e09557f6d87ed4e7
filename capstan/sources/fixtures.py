"""Domain tables derived from the driver's TPC-H-like tables.

The reports read planning-portal and ERP tables (parts, suppliers, tasks,
capacity study lines, purchase orders, BOM explosions ...).  The test data
only has TPC-H-like tables, so each domain table is *derived* from them with
one SQL statement.  The statements use a dialect subset that Spark SQL and
DuckDB both run, so the Spark side (``spark.sql(text, **dataframes)``) and the
DuckDB oracle (the same text as CTEs) start from identical inputs.  Only the
typed timestamp literal differs: ``TSNTZ '...'`` renders as ``TIMESTAMP_NTZ``
in Spark and ``TIMESTAMP`` in DuckDB, keeping every timestamp wall-clock
(timestamp_ntz) like the parquet columns.

Every derived table keeps every row of the table it derives from; a modulus picks
a column's value, never the rows.  Three cases leave rows out because that is the
feature: parts without a part-supplier record, the right side of a merge that lacks
some parts, and a snapshot increment (``FILTERED``).
"""

from __future__ import annotations

from dataclasses import dataclass

FILTERED = ("portal_part_supplier", "erp_dashboard", "snapshot_increment")
#: Tables stored by order key: (input that is dealt, its column, the table's column).
BUCKETED = {"line1": ("lineitem", "l_orderkey", "l_orderkey"), "erp_po": ("orders", "o_orderkey", "PurchaseOrderID")}
BUCKET_BYTES = 8 << 20                    # bytes of the driver tables for each bucket
#: Tables that are columns of the stored line items: read from there, not stored.
VIEWS = ("portal_part_tag", "erp_part_tag", "erp_po_line")
DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


@dataclass(frozen=True)
class Adapter:
    inputs: tuple[str, ...]
    sql: str


def _a(inputs: str, sql: str) -> Adapter:
    return Adapter(tuple(inputs.split()), sql.strip())


ADAPTERS: dict[str, Adapter] = {
    # lineitem with a unique line_id: lines that share (l_orderkey, l_linenumber) are told apart by
    # their rank; every column takes part in the order, so ranks are the same in both engines.
    "line1": _a("lineitem", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate,
       (row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                                    l_returnflag, l_linestatus) - 1) * 1000000000000
       + l_orderkey * 10 + l_linenumber AS line_id
FROM {lineitem}"""),

    # ---------------------------------------------------------------- portal
    "portal_part": _a("part supplier customer", """
SELECT p_partkey AS PartID,
       concat('P', lpad(cast(p_partkey AS string), 6, '0')) AS PartNumber,
       p_name AS Description,
       CASE WHEN p_size % 11 = 10 THEN NULL WHEN p_size % 5 = 0 THEN 1 ELSE 0 END AS FabricatedFlag,
       CASE WHEN p_partkey % 53 = 0 THEN -1
            ELSE p_partkey % (SELECT max(s_suppkey) + 1 FROM {supplier}) END AS PreferredSupplierID,
       (p_partkey * 7) % (SELECT max(c_custkey) + 9 FROM {customer}) AS SIEUserID,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('B', cast((p_partkey * 5) % (SELECT max(c_custkey) + 1 FROM {customer}) AS string)) END AS BuyerCode,
       CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN TSNTZ '1999-01-01 00:00:00'
            ELSE TSNTZ '1997-01-01 00:00:00' END AS EarliestEffectiveDateInBOM,
       CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN TSNTZ '1998-01-01 00:00:00'
            ELSE TSNTZ '2000-01-01 00:00:00' END AS LatestEndDate
FROM {part}"""),
    "portal_supplier": _a("supplier", """
SELECT s_suppkey AS SupplierID,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL
            ELSE concat('V', lpad(cast(s_suppkey AS string), 4, '0')) END AS SupplierCode,
       s_name AS Name
FROM {supplier}"""),
    "portal_part_supplier": _a("portal_part portal_supplier", """
SELECT 100000 + p.PartID AS PartSupplierID, p.PartID, p.PartNumber, s.SupplierCode,
       CASE p.PartID % 4 WHEN 0 THEN 'Approved' WHEN 1 THEN 'D - Prototype / Deviation'
            WHEN 2 THEN 'Pending' END AS PPAPStatus,
       CASE WHEN p.PartID % 5 = 0 THEN NULL ELSE 1 END AS IsPartDefined,
       p.PartID % 27 AS PartSupplierTagID
FROM {portal_part} p JOIN {portal_supplier} s ON p.PreferredSupplierID = s.SupplierID
WHERE p.PartID % 7 <> 6"""),
    # the same rows as a case-insensitive source may hold them
    "portal_part_supplier_mixed": _a("portal_part_supplier", """
SELECT PartSupplierID, PartID, CASE WHEN PartID % 3 = 1 THEN lower(PartNumber) ELSE PartNumber END AS PartNumber,
       CASE PartID % 5 WHEN 1 THEN lower(SupplierCode) WHEN 2 THEN concat(SupplierCode, '  ') ELSE SupplierCode END AS SupplierCode,
       PPAPStatus, IsPartDefined, PartSupplierTagID
FROM {portal_part_supplier}"""),
    "portal_ps_tag": _a("nation", """
SELECT cast(n_nationkey AS bigint) AS PartSupplierTagID,
       CASE n_nationkey WHEN 1 THEN 'Subcontract' WHEN 2 THEN 'Missing' WHEN 3 THEN 'New'
            WHEN 4 THEN 'BOM Error' WHEN 5 THEN 'Rework' WHEN 6 THEN 'Warp Error'
            ELSE 'Regular' END AS Tag
FROM {nation}"""),
    "portal_task": _a("orders", """
SELECT o_orderkey AS PartSupplierTaskID,
       100000 + o_custkey AS PartSupplierID,
       CASE o_orderkey % 3 WHEN 0 THEN 40 WHEN 1 THEN 15 ELSE 41 END AS TaskID,
       CASE o_orderkey % 3 WHEN 0 THEN 'capacity study' WHEN 1 THEN 'run at rate'
            ELSE 'dimensional report' END AS TaskName,
       CASE WHEN (o_orderkey * 7919) % 1009 % 9 IN (0, 8) THEN NULL
            ELSE cast((o_orderkey * 7919) % 1009 % 9 AS int) END AS StatusID,
       CASE WHEN (o_orderkey * 31) % 101 % 12 IN (1, 4)
            THEN cast((o_orderkey * 31) % 101 % 12 AS int) END AS TaskScore,
       CASE WHEN (o_orderkey * 37) % 103 % 12 IN (1, 4)
            THEN cast((o_orderkey * 37) % 103 % 12 AS int) END AS TaskScore1,
       o_orderdate AS CreateDate,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS ModifyDate
FROM {orders}"""),
    "portal_capacity_line": _a("line1", """
SELECT line_id AS CapacityStudyLineID, l_orderkey AS PartSupplierTaskID,
       CASE l_linestatus WHEN 'F' THEN 'Contract' ELSE 'Current Capacity' END AS CapacityType,
       CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Rejected' END AS ApprovalStatus,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(round(l_quantity) AS int) END AS Quoted,
       CASE WHEN l_discount < 0.02 THEN NULL ELSE cast(round(l_tax * 600) AS int) END AS Measured,
       CASE WHEN l_tax < 0.04 THEN NULL ELSE cast(round(l_discount * 500) AS int) END AS Potential,
       CASE WHEN l_discount > 0.08 THEN NULL ELSE cast(round(l_tax * 500) AS int) END AS Designed,
       CASE WHEN l_tax > 0.04 THEN NULL ELSE cast(round(l_discount * 400) AS int) END AS Theoretical,
       l_shipdate AS CreateDate,
       CASE WHEN l_tax < 0.03 THEN NULL ELSE l_shipdate + INTERVAL 10 DAY END AS ModifyDate
FROM {line1}"""),
    "portal_part_tag": _a("line1", """
SELECT line_id AS PartTagID, l_partkey AS PartID,
       CASE WHEN l_orderkey % 6 <> 0 THEN cast(300 + l_orderkey % 6 AS int)
            WHEN l_linenumber = 1 THEN 31 WHEN l_linenumber = 2 THEN 30 WHEN l_linenumber = 3 THEN 124
            ELSE 200 + l_linenumber END AS TagID,
       CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS Enabled,
       l_shipdate AS CreateDate
FROM {line1}"""),
    "portal_tag": _a("nation", """
SELECT 200 + n_nationkey AS TagID,
       CASE n_nationkey WHEN 4 THEN 'Stationary Energy Pack' WHEN 5 THEN 'Old Stationary Energy'
            WHEN 6 THEN 'Stationary Energy label' ELSE 'Other' END AS TagName,
       CASE WHEN n_nationkey = 6 THEN 1 ELSE 2 END AS TagTypeID,
       CASE WHEN n_nationkey = 5 THEN 0 ELSE 1 END AS Enabled
FROM {nation}"""),
    "portal_user": _a("customer", """
SELECT c_custkey AS UserID, c_name AS DisplayName,
       CASE WHEN c_custkey % 8 = 7 THEN NULL
            ELSE (c_custkey * 11) % (SELECT max(c_custkey) + 1 FROM {customer}) END AS ManagerUserID,
       CASE WHEN c_custkey % 3 = 0 THEN ''
            WHEN c_custkey % 3 = 1 THEN concat('B', cast(c_custkey - c_custkey % 6 AS string))
       END AS SAPUserID
FROM {customer}"""),
    "portal_status": _a("nation", """
SELECT n_nationkey AS StatusID, n_name AS Status FROM {nation}"""),

    # ------------------------------------------------------------------- ERP
    "erp_part": _a("portal_part", """
SELECT PartID, PartNumber, Description,
       CASE WHEN PartID % 6 = 0 THEN NULL ELSE concat('SYS', cast(PartID % 6 AS string)) END AS PartSystem,
       BuyerCode, FabricatedFlag,
       CASE PartID % 3 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 0 END AS PurchasedFlag,
       CASE WHEN PartID % 2 = 0 THEN 1 END AS SubContractFlag,
       PreferredSupplierID,
       CASE WHEN PartID % 19 = 0 THEN NULL ELSE cast(PartID % 3 AS int) END AS StockUnitID
FROM {portal_part}"""),
    "erp_part_tag": _a("portal_part_tag", "SELECT PartID FROM {portal_part_tag}"),
    "erp_supplier": _a("portal_supplier", "SELECT SupplierID, SupplierCode, Name FROM {portal_supplier}"),
    "erp_bom_sample": _a("region", """
SELECT cast(148 + r_regionkey AS bigint) AS SalesBOMSampleID,
       concat('Model 3 - ', r_name) AS Name,
       CASE WHEN r_regionkey = 4 THEN TSNTZ '2015-10-09 00:00:00'
            ELSE TSNTZ '2015-10-10 00:00:00' END AS CreateDate
FROM {region}"""),
    "erp_bom_explosion": _a("line1", """
SELECT 148 + l_suppkey % 6 AS SalesBOMSampleID,
       concat('P', lpad(cast(CASE WHEN l_partkey % 41 = 0 THEN l_partkey + 900000 ELSE l_partkey END
                             AS string), 6, '0')) AS DetailPartNumber,
       CASE WHEN l_orderkey % 3 <> 0 THEN TSNTZ '1998-04-01 00:00:00'
            WHEN l_linenumber = 1 THEN TSNTZ '1998-06-13 00:00:00'
            WHEN l_linenumber = 2 THEN TSNTZ '1998-06-08 13:00:00'
            WHEN l_linenumber = 3 THEN TSNTZ '1998-06-08 00:00:00'
            ELSE TSNTZ '1998-05-01 00:00:00' END AS BOMExplosionDate,
       CASE l_returnflag WHEN 'R' THEN 'Purchased' WHEN 'A' THEN 'Sub-contract'
            ELSE 'Fabricated' END AS UsageType,
       CASE WHEN l_quantity > 48 THEN NULL ELSE cast(round(l_quantity * 0.3, 4) AS decimal(18, 4)) END AS RunningQuantity
FROM {line1}"""),
    "erp_po": _a("orders supplier", """
SELECT o_orderkey AS PurchaseOrderID,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 8 WHEN '3' THEN 9
            WHEN '4' THEN 17 ELSE 2 END AS PurchaseOrderTypeID,
       CASE o_orderstatus WHEN 'F' THEN 'C' WHEN 'O' THEN 'R' ELSE 'X' END AS Status,
       o_custkey % (SELECT max(s_suppkey) + 1 FROM {supplier}) AS SupplierID,
       cast(o_custkey % 5 AS int) AS CurrencyID,
       o_orderdate AS CreateDate
FROM {orders}"""),
    "erp_po_line": _a("line1", """
SELECT line_id AS PurchaseOrderLineID, l_orderkey AS PurchaseOrderID,
       CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE l_partkey END AS PartID,
       cast(CASE WHEN l_linenumber = 7 THEN 0 ELSE round(l_extendedprice / l_quantity) END
            AS decimal(18, 4)) AS UnitPrice,
       cast(l_suppkey % 6 AS int) AS PurchaseUnitID,
       CASE l_linestatus WHEN 'F' THEN 'C' ELSE 'A' END AS LineStatus,
       CASE WHEN l_tax >= 0.08 THEN 1 WHEN l_tax >= 0.04 THEN 0 END AS DeliveryCompleteFlag,
       CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS ReturnFlag,
       l_shipdate AS CreateDate
FROM {line1}"""),
    # parts 0 and 1 (mod 4) only have pricing that starts after every cut-off
    "erp_date_pricing": _a("line1 erp_po", """
SELECT l.line_id AS PartSupplierDatePricingID, l.l_partkey AS PartID,
       CASE WHEN l.l_linenumber % 3 = 0 OR po.SupplierID IS NULL THEN l.l_suppkey ELSE po.SupplierID END AS SupplierID,
       cast(l.l_linenumber % 5 AS int) AS CurrencyID,
       cast(round(l.l_extendedprice / 10) AS decimal(18, 4)) AS UnitPrice,
       CASE WHEN l.l_partkey % 4 IN (2, 3) THEN l.l_shipdate ELSE l.l_shipdate + INTERVAL 12 YEAR END AS StartDate
FROM {line1} l LEFT JOIN {erp_po} po ON po.PurchaseOrderID = l.l_orderkey"""),
    "erp_currency": _a("nation", """
SELECT n_nationkey AS CurrencyID, concat('C', cast(n_nationkey AS string)) AS CurrencyCode,
       concat('Currency ', cast(n_nationkey AS string)) AS Name,
       CASE WHEN n_nationkey = 4 THEN NULL ELSE cast(1 + n_nationkey * 0.25 AS double) END AS ExchangeRate
FROM {nation}"""),
    # a few pairs have two month-end rates on the same day
    "erp_fx_map": _a("nation region", """
SELECT n_nationkey % 5 AS FromCurrencyID, cast(floor(n_nationkey / 5) AS int) AS ToCurrencyID,
       CASE WHEN n_nationkey % 7 = 3 THEN 'Average' ELSE 'Month-end' END AS ExchangeRateType,
       CASE WHEN n_nationkey % 6 = 5 THEN TSNTZ '1998-04-30 00:00:00'
            ELSE TSNTZ '1998-05-31 00:00:00' END AS ValidFrom,
       cast(0.5 + n_nationkey * 0.125 AS double) AS ExchangeRate
FROM {nation}
UNION ALL
SELECT r_regionkey AS FromCurrencyID, cast((r_regionkey + 2) % 5 AS int) AS ToCurrencyID, 'Month-end' AS ExchangeRateType,
       TSNTZ '1998-05-31 00:00:00' AS ValidFrom, cast(1.75 + r_regionkey * 0.5 AS double) AS ExchangeRate
FROM {region}"""),
    "erp_unit": _a("region", "SELECT r_regionkey AS UnitID FROM {region}"),
    "erp_unit_conv": _a("region", """
SELECT CASE r_regionkey WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE r_regionkey END AS FromUnitID,
       CASE r_regionkey WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 4 ELSE 5 END AS ToUnitID,
       CASE r_regionkey WHEN 0 THEN cast(2 AS double) WHEN 1 THEN cast(4 AS double)
            ELSE cast(0.5 AS double) END AS ConversionFactor
FROM {region}"""),
    "erp_part_unit_conv": _a("erp_part", """
SELECT PartID, StockUnitID AS FromUnitID, 3 AS ToUnitID, cast(8 AS double) AS ConversionFactor
FROM {erp_part} WHERE StockUnitID IS NOT NULL AND PartID % 2 = 0
UNION ALL
SELECT PartID, 3 AS FromUnitID, StockUnitID AS ToUnitID, cast(0.25 AS double) AS ConversionFactor
FROM {erp_part} WHERE StockUnitID IS NOT NULL AND PartID % 10 = 1
UNION ALL
SELECT PartID, StockUnitID AS FromUnitID, 1 AS ToUnitID, cast(16 AS double) AS ConversionFactor
FROM {erp_part} WHERE StockUnitID IS NOT NULL AND PartID % 4 = 2 AND StockUnitID = 0
UNION ALL
SELECT PartID, 0 AS FromUnitID, StockUnitID AS ToUnitID, cast(0.5 AS double) AS ConversionFactor
FROM {erp_part} WHERE StockUnitID IS NOT NULL AND PartID % 4 = 3 AND StockUnitID = 2
UNION ALL
SELECT PartID, StockUnitID AS FromUnitID, 3 AS ToUnitID, cast(10 AS double) AS ConversionFactor
FROM {erp_part} WHERE StockUnitID IS NOT NULL AND PartID % 4 = 2"""),
    "erp_buyer_mgr": _a("customer", """
SELECT concat('B', cast(c_custkey AS string)) AS BuyerCode, concat('Buyer ', cast(c_custkey AS string)) AS Buyer,
       concat('Mgr ', cast(c_custkey % 4 AS string)) AS Manager
FROM {customer}"""),

    # ------------------------------------------- inputs of the file-driven merges
    # The portal/ERP query files those scripts load are not available; these
    # stand-ins have the shape the merges need (shared key and non-key names,
    # NULL keys on both sides, which grow with the parts).
    "portal_dashboard": _a("portal_part", """
SELECT CASE WHEN PartID % 50 = 49 THEN NULL ELSE PartNumber END AS PartNumber,
       CASE WHEN PartID % 9 = 4 THEN NULL
            ELSE concat('V', lpad(cast(PartID % 997 AS string), 4, '0')) END AS SupplierCode,
       concat('open tasks ', cast(PartID % 5 AS string)) AS value,
       CASE PartID % 3 WHEN 0 THEN 'Tag A' WHEN 1 THEN 'Tag B' END AS TagName
FROM {portal_part}"""),
    "erp_dashboard": _a("erp_part", """
SELECT CASE WHEN PartID % 47 = 7 THEN NULL ELSE PartNumber END AS PartNumber,
       CASE WHEN PartID % 9 = 4 THEN NULL
            ELSE concat('V', lpad(cast(PartID % 997 AS string), 4, '0')) END AS SupplierCode,
       PartSystem AS value,
       CASE PartID % 3 WHEN 0 THEN 'Tag A' WHEN 1 THEN 'Tag B' END AS TagName
FROM {erp_part} WHERE PartID % 3 <> 0"""),
    "snapshot_history": _a("erp_part", """
SELECT '1998-06-08' AS Load_Date, PartNumber,
       CASE PartID % 3 WHEN 0 THEN 'Released' WHEN 1 THEN 'In Work' END AS ECOStatus,
       PartSystem,
       CASE WHEN PartID % 5 = 0 THEN 'Complete' ELSE 'Open' END AS TQPStatus
FROM {erp_part}"""),
    "snapshot_increment": _a("erp_part", """
SELECT '1998-06-15' AS Load_Date, PartNumber,
       CASE PartID % 3 WHEN 0 THEN 'Released' WHEN 1 THEN 'In Work' END AS ECOStatus,
       PartSystem
FROM {erp_part} WHERE PartID % 2 = 0"""),
    # two columns that the loads before did not have, one of theirs gone
    "snapshot_wider": _a("erp_part", """
SELECT '1998-06-22' AS Load_Date, PartNumber, PartSystem,
       CASE WHEN PartID % 5 = 1 THEN 'Complete' ELSE 'Open' END AS TQPStatus, BuyerCode AS Owner, StockUnitID AS Unit
FROM {erp_part}"""),
}


def render(name: str, engine: str) -> str:
    """SQL text of one adapter for ``engine`` in {'spark', 'duckdb'}.

    For Spark the ``{input}`` placeholders stay (they are bound to DataFrames
    by ``spark.sql(text, **inputs)``); for DuckDB they become plain names.
    """
    ad = ADAPTERS[name]
    if engine == "spark":
        return ad.sql.replace("TSNTZ", "TIMESTAMP_NTZ")
    if engine == "duckdb":
        return ad.sql.replace("TSNTZ", "TIMESTAMP").format(**{i: i for i in ad.inputs})
    raise ValueError(engine)


def closure(names) -> list[str]:
    """Adapters needed for ``names`` in dependency order."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in DRIVER_TABLES or n in out:
            return
        for i in ADAPTERS[n].inputs:
            visit(i)
        out.append(n)

    for n in names:
        visit(n)
    return out


def levels(names) -> list[list[str]]:
    """``closure(names)`` grouped by dependency depth (a level only reads earlier levels)."""
    depth: dict[str, int] = {}
    for n in closure(names):
        depth[n] = 1 + max((depth.get(i, -1) for i in ADAPTERS[n].inputs), default=-1)
    out: list[list[str]] = []
    for n, d in depth.items():
        while len(out) <= d:
            out.append([])
        out[d].append(n)
    return out


def duckdb_ctes(names) -> str:
    """``name AS (...)`` CTE list (without WITH) for the adapters ``names`` need."""
    return ",\n".join(f"{n} AS (\n{render(n, 'duckdb')}\n)" for n in closure(names))
