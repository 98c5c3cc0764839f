"""Audit-log JSON: the document paths read from ``changes`` and their types.

Every path is read as text: strings as they stand, booleans as ``true`` / ``false``, JSON null and absent paths
as NULL, numbers exactly as the document spells them (``12.50``, ``1e5``, any number of digits); of a key named
twice the last one counts. Spark's JSON readers spell numbers anew, so the document's numbers are put in quotes
first (one regular expression that passes over strings), and the document is then parsed once per row into a struct.
A document that is no JSON reads as all NULL. Typed columns are cast from the text with ``try_cast``: a
malformed value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: JSON leaves of the audit document and their SQL types ------
CURRENT_FIELDS = (
    ("id", "double"), ("mrp", "double"), ("code", "string"), ("rank", "double"), ("price", "double"),
    ("is_hot", "boolean"), ("weight", "double"), ("barcode", "string"), ("is_aoos", "boolean"),
    ("is_bulk", "boolean"), ("is_deal", "boolean"), ("discount", "double"), ("is_stock", "boolean"),
    ("cities_id", "double"), ("is_active", "boolean"), ("max_limit", "double"), ("min_limit", "double"),
    ("aoos_limit", "double"), ("best_price", "boolean"), ("created_at", "timestamp_ntz"),
    ("deleted_at", "timestamp_ntz"), ("deleted_by", "double"), ("is_deleted", "boolean"), ("is_visible", "boolean"),
    ("product_id", "double"), ("updated_at", "timestamp_ntz"), ("updated_by", "double"),
    ("is_new_label", "boolean"), ("back_in_stock", "boolean"), ("delivery_date", "date"),
    ("current_aoos_inv", "double"), ("fulfilment_mode_id", "double"), ("product_variant_id", "double"),
)
SKU_FIELDS = (
    ("id", "double"), ("price", "double"), ("sku_id", "string"), ("user_id", "double"), ("approved", "boolean"),
    ("quantity", "double"), ("inventory", "double"), ("seller_id", "double"), ("product_id", "double"),
    ("listed_date", "date"),
)
SELLER_CHANGE_FIELDS = (("expiry_date", "date"), ("stock_availability_date", "date"))
# plain decimal number text (sign, digits, optional point and digits)
NUMERIC_TEXT = r"^[-+]?[0-9]*\.?[0-9]+$"
# the text form of updated_at
UPDATED_AT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]'Z'"  # one to six digits of a second, or none
# -------------------------------------------------------------------------------


# a number outside strings: what was passed over since the last one, then the number, then what may follow one
_BARE_NUMBER = (r'\G((?:[^"0-9\-]|"(?:[^"\\]|\\.)*+")*+)(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)(?=[\s,}\]]|$)')


def _struct(fields: tuple[tuple[str, str], ...], more: str = "") -> str:
    return "struct<" + ", ".join(f"{name}: string" for name, _ in fields) + more + ">"


SCHEMA = f"current {_struct(CURRENT_FIELDS)}, sku {_struct(SKU_FIELDS, ', seller_change_requests: ' + _struct(SELLER_CHANGE_FIELDS))}"


def quote_numbers(text: Column) -> Column:
    """The document with its numbers as strings."""
    return F.regexp_replace(text, F.lit(_BARE_NUMBER), F.lit('$1"$2"'))


def parse_changes(col: Column | str = "changes", schema: str = SCHEMA) -> Column:
    return F.from_json(quote_numbers(F.col(col) if isinstance(col, str) else col), schema)


def leaf_columns(doc: str = "_doc") -> list[tuple[str, Column, str]]:
    """(output name, text column, SQL type) for every path, in report order."""
    groups = (("", "current", CURRENT_FIELDS), ("sku_", "sku", SKU_FIELDS),
              ("sku_", "sku.seller_change_requests", SELLER_CHANGE_FIELDS))
    return [(prefix + name, F.col(f"{doc}.{path}.{name}"), typ) for prefix, path, fields in groups for name, typ in fields]


def typed(text: Column, sql_type: str) -> Column:
    return text if sql_type == "string" else text.try_cast(sql_type)
