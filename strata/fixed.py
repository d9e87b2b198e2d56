"""Values that results depend on."""

# Results agree with those of other implementations only if these stay as they are.

#: Statuses an order may have, and the one that counts as revenue.
ORDER_STATUSES = ("created", "paid", "cancelled")
PAID = "paid"

#: Kinds of sales events.
SALE = "SALE"
ADJUSTMENT = "ADJUSTMENT"
CANCEL = "CANCEL"

#: Kinds of changes in a change set.
UPDATE = "update"
DELETE = "delete"
INSERT = "insert"

#: Names made from texts: longest name, name of an empty text, what goes before a digit.
IDENTIFIER_LENGTH = 40
IDENTIFIER_FALLBACK = "student"
IDENTIFIER_DIGIT_PREFIX = "u_"

#: Columns of the order feed; all of them arrive as text.
ORDER_FEED_SCHEMA = (
    "order_id STRING, customer_id STRING, order_ts STRING, channel STRING,"
    " amount STRING, status STRING, country STRING"
)
