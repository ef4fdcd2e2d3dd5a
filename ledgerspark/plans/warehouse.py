"""Warehouse shipment extracts and ERP/WMS reconciliation (D1-D7), composed
from the join, filter, text and set operators.

The reference runs these as SQL text against its warehouse databases. Here
each is a DataFrame plan over any frames with the same roles; ``plans.q_warehouse``
feeds them frames derived from the driver tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from ledgerspark.functions.codes import warehouse_name
from ledgerspark.functions.dates import lookback
from ledgerspark.functions.numeric import round_money, to_int_code
from ledgerspark.functions.text import concat_lenient, concat_strict, date_text, normalise_error_text
from ledgerspark.operators import recon

WMS_COLUMNS = ("Key", "order_Id", "pallet_Id", "item_Id", "unit_Quantity", "dispatched_Date",
               "wareHouse_Id", "source")
AX_COLUMNS = ("Key", "OrderID", "PalletID", "WarehouseID", "Source", "ItemID", "OrderCreationDate")


def site_shipments(history: DataFrame, site_col: str, site_value, pallet_col: str, item_col: str,
                   order_col: str, qty_col: str, dispatch_col: str, source: str, as_of, days: int = 30,
                   strict_key: bool = False, midnight: bool = False, group_max: bool = False) -> DataFrame:
    """One site's dispatched pallets in the look-back window.

    ``history`` is the joined pallet history (J1 is the caller's join chain).
    Key = site + pallet + item, with the Snowflake (``strict_key``: NULL if a
    part is NULL) or T-SQL (NULL read as '') CONCAT rule; DISTINCT, then either
    GROUP BY every column (A2) or a max() per grouped column (A3)."""
    concat = concat_strict if strict_key else concat_lenient
    rows = (history
            .filter(F.col(site_col) == F.lit(site_value))
            .filter(lookback(dispatch_col, as_of, days, midnight=midnight))
            .select(concat(F.col(site_col).cast("int"), F.col(pallet_col), F.col(item_col)).alias("Key"),
                    F.col(order_col).alias("order_Id"), F.col(pallet_col).alias("pallet_Id"),
                    F.col(item_col).alias("item_Id"), F.col(qty_col).alias("unit_Quantity"),
                    date_text(dispatch_col).alias("dispatched_Date"), F.col(site_col).alias("wareHouse_Id"),
                    F.lit(source).alias("source"))
            .distinct())
    if group_max:
        return group_by_all_max(rows)
    return recon.dedupe(rows)


def group_by_all_max(df: DataFrame) -> DataFrame:
    """A3: GROUP BY every column and select max() of each (equal to the key)."""
    keys = [F.col(f"`{c}`").alias(f"_g{i}") for i, c in enumerate(df.columns)]
    out = df.groupBy(*keys).agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def all_sites(*extracts: DataFrame) -> DataFrame:
    """UNION ALL of the site extracts (by position)."""
    return recon.union_all(*[e.select(*WMS_COLUMNS) for e in extracts])


@dataclass(frozen=True)
class SiteRule:
    """How one site's extract is built (D1-D3 differ only in these)."""
    site: object
    source: str
    strict_key: bool = False
    midnight: bool = False
    days: int = 30


def all_sites_one_pass(history: DataFrame, rules, site_col: str, pallet_col: str, item_col: str,
                       order_col: str, qty_col: str, dispatch_col: str, as_of) -> DataFrame:
    """D4 in one pass: the same rows as UNION ALL of ``site_shipments`` per
    rule, but the joined history is read once. Each site's CONCAT rule,
    look-back and tag become expressions chosen by the site value; one
    DISTINCT follows (rows of different sites differ in ``source``, so the
    union of per-site distinct sets is this distinct set)."""
    site = F.col(site_col)
    keep = None
    key = tag = None
    for r in rules:
        is_site = site == F.lit(r.site)
        cond = is_site & lookback(dispatch_col, as_of, r.days, midnight=r.midnight)
        keep = cond if keep is None else keep | cond
        concat = concat_strict if r.strict_key else concat_lenient
        k = concat(site.cast("int"), F.col(pallet_col), F.col(item_col))
        key = F.when(is_site, k) if key is None else key.when(is_site, k)
        tag = F.when(is_site, F.lit(r.source)) if tag is None else tag.when(is_site, F.lit(r.source))
    rows = history.filter(site.isin(*[r.site for r in rules]) & keep).select(
        key.alias("Key"), F.col(order_col).alias("order_Id"), F.col(pallet_col).alias("pallet_Id"),
        F.col(item_col).alias("item_Id"), F.col(qty_col).alias("unit_Quantity"),
        date_text(dispatch_col).alias("dispatched_Date"), site.alias("wareHouse_Id"), tag.alias("source"))
    return recon.dedupe(rows)


def failed_transfers(je: DataFrame, as_of, days: int = 90, status=11) -> DataFrame:
    """Failed transfer requests of the last ``days`` with a given status.

    ``je`` columns: INVENTLOCATIONIDFROM, INVENTLOCATIONIDTO, ITEMID,
    ORDERMULTIPLE, ORDERQTY, CREATEDDATETIME, ERRORMESSAGE, STATUS."""
    return (je.filter((F.col("STATUS") == F.lit(status)) & lookback("CREATEDDATETIME", as_of, days))
            .select(concat_lenient("INVENTLOCATIONIDFROM", "INVENTLOCATIONIDTO", "ITEMID").alias("Key"),
                    F.col("INVENTLOCATIONIDFROM").alias("AX_WarehouseID"),
                    F.col("INVENTLOCATIONIDTO").alias("AX_StoreID"),
                    F.col("ITEMID").alias("AX_ItemId"),
                    round_money("ORDERMULTIPLE").alias("OrderMultiple"),
                    round_money("ORDERQTY").alias("OrderQuantity"),
                    date_text("CREATEDDATETIME").alias("CreatedDateTime"),
                    normalise_error_text("ERRORMESSAGE").alias("ErrorMessage"))
            .distinct())


def erp_orders(transfers: DataFrame, sales: DataFrame) -> DataFrame:
    """D6 tail: UNION (distinct) of the transfer and sales branches (each
    already grouped), then the staging key, the site name and DISTINCT.

    Branch columns: OrderID, PalletID, WarehouseID, ItemID, OrderCreationDate."""
    cols = ("OrderID", "PalletID", "WarehouseID", "ItemID", "OrderCreationDate")
    ax = recon.union_distinct(transfers.select(*cols), sales.select(*cols))
    return ax.select(
        concat_lenient(to_int_code("WarehouseID"), "OrderID", "PalletID").alias("Key"),
        "OrderID", "PalletID", "WarehouseID", warehouse_name("WarehouseID").alias("Source"),
        "ItemID", "OrderCreationDate").distinct()


def reconcile_orders(wms: DataFrame, ax: DataFrame) -> DataFrame:
    """WMS staging against ERP staging by Key (J4) with the fulfilment
    status (P7) and pipeline date (P9)."""
    w = wms.select(F.col("Key").alias("wms_key"), F.col("order_Id").alias("wms_orderID"),
                   F.col("pallet_Id").alias("wms_palletID"), F.col("item_Id").alias("wms_itemID"),
                   F.col("unit_Quantity").alias("wms_unitQuantity"),
                   F.col("dispatched_Date").alias("wms_dispatchedDate"),
                   F.col("wareHouse_Id").alias("wms_warehouse_id"), F.col("source").alias("wms_source"))
    a = ax.select(F.col("Key").alias("ax_key"), F.col("OrderID").alias("ax_orderID"),
                  F.col("PalletID").alias("ax_palletID"), F.col("ItemID").alias("ax_itemID"),
                  F.col("OrderCreationDate").alias("ax_created_date"),
                  F.col("WarehouseID").alias("ax_warehouse_id"), F.col("Source").alias("ax_source"))
    both = recon.reconcile(w, a, "wms_key", "ax_key")
    return both.select("*", *recon.fulfilment_columns(F.col("ax_palletID"), F.col("wms_palletID"),
                                                      F.col("ax_created_date"), F.col("wms_dispatchedDate")))
