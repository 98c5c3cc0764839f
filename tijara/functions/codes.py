"""Code tables and decoding.

Decoding a small integer code into a label is a chain of ``CASE WHEN`` branches
(JVM-side, codegen'd); the tables are parameters so a deployment can swap labels
without touching the plans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (labels the outputs must carry) -------------------------
ORDER_STATUS = {
    0: "Pending", 1: "In Preparation", 2: "Ready to Ship", 3: "In Transit", 4: "Delivered",
    5: "Closed", 6: "Cancelled", 7: "Return", 8: "Shop Closed", 9: "Waiting for approval",
}
# the shorter status map of the monthly drop-ship report (no 1, 7-9; 3 is 'Shipped')
ORDER_STATUS_SHORT = {0: "Pending", 2: "Ready To Ship", 3: "Shipped", 4: "Delivered", 5: "Closed", 6: "Cancelled"}
ORDER_TYPE = {1: "Regular Order", 2: "Spot Sale"}
FULFILMENT_MODE = {1: "Fulfilled", 2: "WaaS", 3: "Drop Shipping"}
VERTICAL = {1: "FMCG", 2: "Construction", 3: "Chemicals"}
PAYMENT_MODE = {1: "COD", 2: "Finja", 3: "BNPL", 4: "Wallet"}
SUPPLIER_TYPE = ("Inventory-Led", "Marketplace", "Other")  # is_internal true / false / unknown
ORDER_CHANNEL = ("Retailer App", "Sales Portal")            # created_by NULL / set
SIZE_CLASS = ("RDS", "BULK")                                 # below / at-or-above threshold
RETURN_REASONS = ("Wastage", "Lost/Stolen", "Wrong data entry")
AUDIT_MESSAGES = (
    "Product SKU Updated successfully",
    "Item added successfully",
    "Product deleted successfully",
    "SKU Request updated successfully",
    "Seller change request updated by admin",
    "Out of stock marked manually",
    "SKU updated successfully",
    "Product updated successfully",
    "Product SKU Updated successfully By Admin",
    "Item updated successfully",
    "Item deleted successfully",
    "SKU updated successfully by retailer",
    "Product SKU Detail created successfully",
    "Product SKU created successfully",
)
# --------------------------------------------------------------------------

_AS_TEXT = object()


def decode(code: Column | str, mapping: Mapping[int, str], default=_AS_TEXT) -> Column:
    """``CASE WHEN code = k THEN label ... ELSE default END``.

    ``default``: omitted -> the code as text; ``None`` -> NULL; any other value -> that literal.
    A NULL code never matches and falls to the default (``cast(NULL as string)`` is NULL).
    """
    c = F.col(code) if isinstance(code, str) else code
    out = None
    for key, label in mapping.items():
        out = F.when(c == key, F.lit(label)) if out is None else out.when(c == key, F.lit(label))
    if default is _AS_TEXT:
        return out.otherwise(c.cast("string"))
    if default is None:
        return out
    return out.otherwise(F.lit(default))


def tri_state(flag: Column | str, if_true: str, if_false: str, otherwise: str) -> Column:
    """Nullable boolean -> one of three labels (NULL takes ``otherwise``)."""
    c = F.col(flag) if isinstance(flag, str) else flag
    return F.when(c, F.lit(if_true)).when(~c, F.lit(if_false)).otherwise(F.lit(otherwise))


def any_true(*conditions: Column) -> Column:
    """``CASE WHEN a OR b ... THEN true ELSE false END``: NULL conditions count as false."""
    cond = conditions[0]
    for c in conditions[1:]:
        cond = cond | c
    return F.coalesce(cond, F.lit(False))


def presence_flag(col: Column | str, when_null: str, when_set: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), F.lit(when_null)).otherwise(F.lit(when_set))


def size_class(value: Column | str, threshold: float, below: str = SIZE_CLASS[0], at_or_above: str = SIZE_CLASS[1]) -> Column:
    """``CASE WHEN value < threshold THEN below ELSE at_or_above``; NULL falls to the ELSE branch."""
    c = F.col(value) if isinstance(value, str) else value
    return F.when(c < F.lit(threshold), F.lit(below)).otherwise(F.lit(at_or_above))
