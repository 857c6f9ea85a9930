"""The reference's table definitions as Spark schemas.

INT money columns are widened to BIGINT where they are multiplied
(``operators.aggregate.revenue``); keys are checked by the R05-R07 queries
since the session catalog has no PRIMARY / FOREIGN KEY constraints.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# --- fixed values: column lists of the reference's tables -------------------
SALES = ("order_id INT, order_date DATE, customer_id STRING, region STRING, "
         "product STRING, quantity INT, price INT")
CUSTOMERS = "customer_id STRING, customer_name STRING, region STRING"
ORDERS = "order_id INT, customer_id STRING, order_date DATE"
ORDER_ITEMS = "order_id INT, product STRING, quantity INT, price INT"
SALES_CSV = "order_id INT, region STRING, product STRING, quantity DOUBLE, price DOUBLE"
TRANSACTIONS_CSV = "transaction_id STRING, customer_id STRING, amount STRING, currency STRING, status STRING"
RULES_CSV = "transaction_id STRING, price BIGINT, quantity BIGINT"
USERS_CSV = "id STRING, name STRING, age STRING, email STRING"
# Keys the reference declares.
PRIMARY_KEYS = {"customers": "customer_id", "orders": "order_id"}
FOREIGN_KEYS = {("orders", "customer_id"): "customers", ("order_items", "order_id"): "orders"}
# ---------------------------------------------------------------------------


def schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
