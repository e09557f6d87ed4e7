"""Declared schemas of the domain tables (types as SURVEY §1.2 implies them).

Readers of text sources (CSV) and JDBC ``customSchema`` use these, so no
schema is inferred from the data; the derived test tables conform to them
(``tests/test_sources.py``).  Timestamps are wall-clock (``TIMESTAMP_NTZ``).
"""

SCHEMAS: dict[str, str] = {
    "portal_part": (
        "PartID BIGINT, PartNumber STRING, Description STRING, FabricatedFlag INT, "
        "PreferredSupplierID BIGINT, SIEUserID BIGINT, BuyerCode STRING, "
        "EarliestEffectiveDateInBOM TIMESTAMP_NTZ, LatestEndDate TIMESTAMP_NTZ"),
    "portal_supplier": "SupplierID BIGINT, SupplierCode STRING, Name STRING",
    "portal_part_supplier": (
        "PartSupplierID BIGINT, PartID BIGINT, PartNumber STRING, SupplierCode STRING, "
        "PPAPStatus STRING, IsPartDefined INT, PartSupplierTagID BIGINT"),
    "portal_part_supplier_mixed": (
        "PartSupplierID BIGINT, PartID BIGINT, PartNumber STRING, SupplierCode STRING, "
        "PPAPStatus STRING, IsPartDefined INT, PartSupplierTagID BIGINT"),
    "portal_ps_tag": "PartSupplierTagID BIGINT, Tag STRING",
    "portal_task": (
        "PartSupplierTaskID BIGINT, PartSupplierID BIGINT, TaskID INT, TaskName STRING, "
        "StatusID INT, TaskScore INT, TaskScore1 INT, CreateDate TIMESTAMP_NTZ, "
        "ModifyDate TIMESTAMP_NTZ"),
    "portal_capacity_line": (
        "CapacityStudyLineID BIGINT, PartSupplierTaskID BIGINT, CapacityType STRING, "
        "ApprovalStatus STRING, Quoted INT, Measured INT, Potential INT, Designed INT, "
        "Theoretical INT, CreateDate TIMESTAMP_NTZ, ModifyDate TIMESTAMP_NTZ"),
    "portal_part_tag": "PartTagID BIGINT, PartID BIGINT, TagID INT, Enabled INT, CreateDate TIMESTAMP_NTZ",
    "portal_tag": "TagID INT, TagName STRING, TagTypeID INT, Enabled INT",
    "portal_user": "UserID BIGINT, DisplayName STRING, ManagerUserID BIGINT, SAPUserID STRING",
    "portal_status": "StatusID INT, Status STRING",
    "erp_part": (
        "PartID BIGINT, PartNumber STRING, Description STRING, PartSystem STRING, "
        "BuyerCode STRING, FabricatedFlag INT, PurchasedFlag INT, SubContractFlag INT, "
        "PreferredSupplierID BIGINT, StockUnitID INT"),
    "erp_part_tag": "PartID BIGINT",
    "erp_supplier": "SupplierID BIGINT, SupplierCode STRING, Name STRING",
    "erp_bom_sample": "SalesBOMSampleID BIGINT, Name STRING, CreateDate TIMESTAMP_NTZ",
    "erp_bom_explosion": (
        "SalesBOMSampleID BIGINT, DetailPartNumber STRING, BOMExplosionDate TIMESTAMP_NTZ, "
        "UsageType STRING, RunningQuantity DECIMAL(18,4)"),
    "erp_po": (
        "PurchaseOrderID BIGINT, PurchaseOrderTypeID INT, Status STRING, SupplierID BIGINT, "
        "CurrencyID INT, CreateDate TIMESTAMP_NTZ"),
    "erp_po_line": (
        "PurchaseOrderLineID BIGINT, PurchaseOrderID BIGINT, PartID BIGINT, "
        "UnitPrice DECIMAL(18,4), PurchaseUnitID INT, LineStatus STRING, DeliveryCompleteFlag INT, "
        "ReturnFlag INT, CreateDate TIMESTAMP_NTZ"),
    "erp_date_pricing": (
        "PartSupplierDatePricingID BIGINT, PartID BIGINT, SupplierID BIGINT, CurrencyID INT, "
        "UnitPrice DECIMAL(18,4), StartDate TIMESTAMP_NTZ"),
    "erp_currency": "CurrencyID INT, CurrencyCode STRING, Name STRING, ExchangeRate DOUBLE",
    "erp_fx_map": (
        "FromCurrencyID INT, ToCurrencyID INT, ExchangeRateType STRING, ValidFrom TIMESTAMP_NTZ, "
        "ExchangeRate DOUBLE"),
    "erp_unit": "UnitID INT",
    "erp_unit_conv": "FromUnitID INT, ToUnitID INT, ConversionFactor DOUBLE",
    "erp_part_unit_conv": "PartID BIGINT, FromUnitID INT, ToUnitID INT, ConversionFactor DOUBLE",
    "erp_buyer_mgr": "BuyerCode STRING, Buyer STRING, Manager STRING",
    "portal_dashboard": "PartNumber STRING, SupplierCode STRING, value STRING, TagName STRING",
    "erp_dashboard": "PartNumber STRING, SupplierCode STRING, value STRING, TagName STRING",
    "snapshot_history": (
        "Load_Date STRING, PartNumber STRING, ECOStatus STRING, PartSystem STRING, "
        "TQPStatus STRING"),
    "snapshot_increment": "Load_Date STRING, PartNumber STRING, ECOStatus STRING, PartSystem STRING",
    "snapshot_wider": "Load_Date STRING, PartNumber STRING, PartSystem STRING, TQPStatus STRING, Owner STRING, Unit INT",
}
