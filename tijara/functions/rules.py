"""Business-rule measures as Column builders.

Every rule is a searched CASE whose first matching branch wins. Inputs are named by
role so the same rule runs on any joined frame::

    mode   fulfilment_mode_id   (1, 2 = own/warehouse flow, 3 = drop-ship)
    status order status         (4, 5 = delivered/closed, 6 = cancelled)
    stop   stop status          (4 = partially returned, 5 = fully returned)
    type   order type           (1 = regular, 2 = spot sale)

A NULL code never satisfies ``IN``/``=`` and falls through to a later branch.
Branches that return NULL mean "not applicable" and are kept distinct from 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OWN_FLOW = (1, 2)
DROP_SHIP = (3,)
DELIVERED = (4, 5)
CANCELLED = 6
STOP_PARTIAL_RETURN = 4
STOP_FULL_RETURN = 5
REGULAR = 1
SPOT_SALE = 2


def c0(col: Column) -> Column:
    """coalesce(x, 0)"""
    return F.coalesce(col, F.lit(0))


@dataclass(frozen=True)
class ItemCols:
    """Column names of one order-item row joined with its order and stop."""

    mode: str = "fulfilment_mode_id"
    status: str = "status"
    stop_status: str = "stop_status"
    stop_key: str = "stop_ref"        # stops.id (NULL when the order has no stop row)
    order_stop: str = "stop_id"        # orders.stop_id
    type: str = "type"
    qty: str = "qty"
    picked: str = "picked_qty"
    returned: str = "return_qty"
    price: str = "price"
    discount: str = "discount"
    commission: str = "commission_value"

    def col(self, role: str) -> Column:
        return F.col(getattr(self, role))


class Rules:
    """The quantity and GMV rules over one item frame (see module doc)."""

    def __init__(self, cols: ItemCols = ItemCols()):
        self.k = cols

    # predicates
    def own_flow(self) -> Column:
        return self.k.col("mode").isin(*OWN_FLOW)

    def drop_ship(self) -> Column:
        return self.k.col("mode").isin(*DROP_SHIP)

    def delivered(self) -> Column:
        return self.k.col("status").isin(*DELIVERED)

    def cancelled(self) -> Column:
        return self.k.col("status") == CANCELLED

    def is_type(self, t: int) -> Column:
        return self.k.col("type") == t

    def full_return_stop(self) -> Column:
        return self.k.col("stop_status") == STOP_FULL_RETURN

    # quantities (order-mart definitions)
    def qty_ordered(self) -> Column:
        return F.when(self.is_type(REGULAR), c0(self.k.col("qty"))).otherwise(0)

    def picked_qty(self) -> Column:
        return F.when(self.own_flow(), c0(self.k.col("picked")))

    def dispatched_qty(self) -> Column:
        return (F.when(self.drop_ship(), F.lit(None))
                .when(self.is_type(REGULAR) & self.own_flow(), c0(self.k.col("picked"))).otherwise(0))

    def spot_sold_qty(self) -> Column:
        return (F.when(self.drop_ship(), F.lit(None))
                .when(self.is_type(SPOT_SALE) & self.own_flow(), c0(self.k.col("picked"))).otherwise(0))

    def delivered_qty(self, drop_ship_uses_picked: bool = False) -> Column:
        """Net delivered quantity. Own flow nets picked; drop-ship nets ordered qty
        (or picked, the variant behind the order-value apportioning key)."""
        k = self.k
        ds_base = k.col("picked") if drop_ship_uses_picked else k.col("qty")
        return (F.when(self.own_flow() & self.delivered(), c0(k.col("picked")) - c0(k.col("returned")))
                .when(self.own_flow() & self.full_return_stop(), F.lit(0))
                .when(self.drop_ship() & self.delivered(), c0(ds_base) - c0(k.col("returned")))
                .otherwise(0))

    def return_qty(self) -> Column:
        k = self.k
        return (F.when(self.own_flow() & self.delivered(), c0(k.col("returned")))
                .when(self.own_flow() & self.full_return_stop(), c0(k.col("picked")))
                .when(self.drop_ship() & self.delivered(), c0(k.col("returned")))
                .otherwise(0))

    def cancelled_qty(self) -> Column:
        return F.when(self.cancelled(), c0(self.k.col("qty"))).otherwise(0)

    def pre_dispatch_cancelled_qty(self) -> Column:
        k = self.k
        return (F.when(self.own_flow() & self.cancelled() & k.col("stop_key").isNull(), c0(k.col("qty")))
                .when(self.drop_ship(), F.lit(None)).otherwise(0))

    def total_pre_dispatch_cancelled_qty(self) -> Column:
        return F.when(self.own_flow() & self.cancelled(), c0(self.k.col("qty"))).otherwise(0)

    def cancelled_gmv_qty(self) -> Column:
        return (F.when(self.own_flow() & self.cancelled(), c0(self.k.col("qty")))
                .when(self.drop_ship(), F.lit(None)).otherwise(0))

    # money (order-mart definitions)
    def price(self) -> Column:
        return self.k.col("price")

    def punched_gmv(self) -> Column:
        return self.qty_ordered() * self.price()

    def delivered_gmv(self) -> Column:
        return self.delivered_qty() * self.price()

    def cancelled_gmv(self) -> Column:
        return self.cancelled_gmv_qty() * self.price()

    def pre_dispatch_cancelled_gmv(self) -> Column:
        return self.cancelled_qty() * self.price()

    def value(self) -> Column:
        """Item value behind order / order-SKU totals and payment apportioning."""
        return self.price() * self.delivered_qty(drop_ship_uses_picked=True)

    def actualized_commission(self) -> Column:
        """rate% / 100 x delivered qty x price, in floating point."""
        k = self.k
        return (k.col("commission").cast("double") / 100 * self.delivered_qty().cast("double")
                * k.col("price").cast("double"))

    # ---- funnel (fulfilment report) definitions ---------------------------
    def funnel_qty_ordered(self) -> Column:
        k = self.k
        return F.when(k.col("order_stop").isNotNull() & self.is_type(REGULAR), k.col("qty")).otherwise(0)

    def funnel_dispatched_qty(self) -> Column:
        return F.when(self.is_type(REGULAR), c0(self.k.col("picked"))).otherwise(0)

    def funnel_spot_sold_qty(self) -> Column:
        return F.when(self.is_type(SPOT_SALE), c0(self.k.col("picked"))).otherwise(0)

    def _stop_returned(self) -> Column:
        k = self.k
        return (F.when(k.col("stop_status") == STOP_PARTIAL_RETURN, c0(k.col("returned")))
                .when(k.col("stop_status") == STOP_FULL_RETURN, c0(k.col("picked"))).otherwise(0))

    def funnel_return_qty(self) -> Column:
        """Returned at the stop minus spot-sold picked qty (uncoalesced: NULL propagates)."""
        return self._stop_returned() - F.when(self.is_type(SPOT_SALE), self.k.col("picked")).otherwise(0)

    def funnel_punched_gmv(self) -> Column:
        k = self.k
        return F.when(self.is_type(REGULAR), k.col("price") * k.col("qty")).otherwise(0)

    def funnel_ordered_gmv(self) -> Column:
        k = self.k
        return F.when(k.col("order_stop").isNotNull() & self.is_type(REGULAR), k.col("price") * k.col("qty")).otherwise(0)

    def funnel_dispatched_gmv(self) -> Column:
        k = self.k
        return F.when(self.is_type(REGULAR), k.col("price") * c0(k.col("picked"))).otherwise(0)

    def funnel_return_gmv(self) -> Column:
        k = self.k
        return (self._stop_returned() * k.col("price")
                - F.when(self.is_type(SPOT_SALE), k.col("picked") * k.col("price")).otherwise(0))

    def bulk_discount(self) -> Column:
        return F.when(self.delivered(), self.k.col("discount")).otherwise(0)

    # ---- drop-ship monthly report definitions -----------------------------
    def ds_qty_ordered(self) -> Column:
        return F.when(self.is_type(REGULAR), self.k.col("qty")).otherwise(0)

    def ds_delivered_qty(self) -> Column:
        k = self.k
        return F.when(self.delivered(), c0(k.col("qty")) - c0(k.col("returned"))).otherwise(0)

    def ds_ordered_gmv(self) -> Column:
        k = self.k
        return F.when(self.is_type(REGULAR), k.col("price") * k.col("qty")).otherwise(0)

    def ds_delivered_gmv(self) -> Column:
        k = self.k
        return F.when(self.delivered(), (c0(k.col("qty")) - c0(k.col("returned"))) * k.col("price")).otherwise(0)

    def ds_commission_value(self) -> Column:
        return self.ds_delivered_gmv().cast("double") * (self.k.col("commission").cast("double") / 100.0)


def guarded_ratio(num: Column, den: Column) -> Column:
    """``CASE WHEN den != 0 THEN num / den ELSE 0``: 0 when den is 0 or NULL."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def safe_ratio(num: Column, den: Column) -> Column:
    """``SAFE_DIVIDE``: NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))
