"""Data model: bronze schemas, event keys, business keys and layouts per entity.

Event times are wall-clock values without a zone, so they are kept as
``TIMESTAMP_NTZ`` end to end: results do not depend on the session time zone of
whichever cluster runs the job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the data contract (must stay exactly as written).
STATUS_PAID = "Succesfull"
STATUS_UNPAID = "Failed"
UNKNOWN_SUBSIDIARY = "UNKNOWN"

TS = T.TimestampNTZType()
MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


@dataclass(frozen=True)
class Entity:
    """One change-event table.

    ``event_key`` identifies one event (redeliveries share it);
    ``business_key`` identifies the entity whose state the events describe.
    """

    name: str
    bronze_schema: T.StructType
    event_key: tuple[str, ...]
    business_key: tuple[str, ...]
    partition_col: str = "transaction_date"
    has_status: bool = False

    @property
    def payload(self) -> list[str]:
        """Bronze columns other than the event key and the ingestion stamp."""
        skip = set(self.event_key) | {"ingestion_date"}
        return [f.name for f in self.bronze_schema.fields if f.name not in skip]

    @property
    def silver_columns(self) -> list[str]:
        cols = [f.name for f in self.bronze_schema.fields if f.name != "ingestion_date"]
        cols.append("bronze_ingestion_date")
        if self.has_status:
            cols.append("transaction_status")
        return cols

    @property
    def silver_schema(self) -> T.StructType:
        fields = [f for f in self.bronze_schema.fields if f.name != "ingestion_date"]
        fields.append(T.StructField("bronze_ingestion_date", TS, True))
        if self.has_status:
            fields.append(T.StructField("transaction_status", T.StringType(), True))
        fields.append(T.StructField("line_created_at", TS, True))
        fields.append(T.StructField("is_current_record", T.BooleanType(), True))
        return T.StructType(fields)


PURCHASE = Entity(
    name="purchase",
    bronze_schema=_schema(
        ("transaction_datetime", TS),
        ("transaction_date", T.DateType()),
        ("purchase_id", T.LongType()),
        ("buyer_id", T.LongType()),
        ("prod_item_id", T.LongType()),
        ("order_date", T.DateType()),
        ("release_date", T.DateType()),
        ("producer_id", T.LongType()),
        ("ingestion_date", TS),
    ),
    event_key=("purchase_id", "transaction_datetime"),
    business_key=("purchase_id",),
    has_status=True,
)

PRODUCT_ITEM = Entity(
    name="product_item",
    bronze_schema=_schema(
        ("transaction_datetime", TS),
        ("transaction_date", T.DateType()),
        ("purchase_id", T.LongType()),
        ("product_id", T.LongType()),
        ("item_quantity", T.IntegerType()),
        ("purchase_value", MONEY),
        ("ingestion_date", TS),
    ),
    event_key=("purchase_id", "product_id", "transaction_datetime"),
    business_key=("purchase_id", "product_id"),
)

EXTRA_INFO = Entity(
    name="purchase_extra_info",
    bronze_schema=_schema(
        ("transaction_datetime", TS),
        ("transaction_date", T.DateType()),
        ("purchase_id", T.LongType()),
        ("subsidiary", T.StringType()),
        ("ingestion_date", TS),
    ),
    event_key=("purchase_id", "transaction_datetime"),
    business_key=("purchase_id",),
)

ENTITIES = {e.name: e for e in (PURCHASE, PRODUCT_ITEM, EXTRA_INFO)}

# Fixed values of the data contract: the columns of the ledger, quarantine, metrics and mart tables.
# Gold ledger: one row per (purchase, product) per snapshot day ("item" grain);
# the "purchase" grain keeps one product per purchase like the original ledger.
LEDGER_SCHEMA = _schema(
    ("transaction_datetime", TS),
    ("purchase_id", T.LongType()),
    ("buyer_id", T.LongType()),
    ("prod_item_id", T.LongType()),
    ("order_date", T.DateType()),
    ("release_date", T.DateType()),
    ("producer_id", T.LongType()),
    ("product_id", T.LongType()),
    ("item_quantity", T.IntegerType()),
    ("purchase_value", MONEY),
    ("subsidiary", T.StringType()),
    ("snapshot_datetime", TS),
    ("snapshot_date", T.DateType()),
    ("transaction_date", T.DateType()),
)
LEDGER_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields]

QUARANTINE_COLUMNS = [
    "snapshot_date",
    "purchase_id",
    "buyer_id",
    "prod_item_id",
    "order_date",
    "release_date",
    "producer_id",
    "subsidiary",
    "transaction_date",
    "snapshot_datetime",
]

QUARANTINE_SCHEMA = T.StructType([f for c in QUARANTINE_COLUMNS for f in LEDGER_SCHEMA.fields if f.name == c])

DQ_SCHEMA = _schema(
    ("snapshot_date", T.DateType()),
    ("total_purchases_asof", T.LongType()),
    ("succeded_transactions", T.LongType()),
    ("missing_product_item_cnt", T.LongType()),
    ("missing_extra_info_cnt", T.LongType()),
    ("unknown_subsidiary_cnt", T.LongType()),
    ("gvm_rows", T.LongType()),
    ("gmv_total_value", T.DoubleType()),
    ("snapshot_datetime", TS),
)

# Exact sums behind the mart of a day as it is known now.
RESTATED_SCHEMA = _schema(
    ("release_date", T.DateType()),
    ("subsidiary", T.StringType()),
    ("purchases", T.LongType()),
    ("rows", T.LongType()),
    ("gmv", T.DecimalType(38, 2)),
    ("snapshot_date", T.DateType()),
)
DAYS_SCHEMA = _schema(("snapshot_date", T.DateType()))

MARK_SCHEMA = _schema(("mark", TS))

MART_SCHEMA = _schema(
    ("snapshot_date", T.DateType()),
    ("release_date", T.DateType()),
    ("subsidiary", T.StringType()),
    ("gmv_value", T.DoubleType()),
    ("transaction_count", T.LongType()),
)
