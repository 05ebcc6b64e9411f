"""Explicit schemas: nothing is inferred anywhere in the library."""

from pyspark.sql import types as T

# Headerless behaviour CSV: user, item title, behaviour, hours. A fifth field
# on a line is ignored because the schema names only four.
BEHAVIOUR_CSV_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("item", T.StringType(), True),
    T.StructField("behaviour", T.StringType(), True),
    T.StructField("hours", T.DoubleType(), True),
])

# Columns of a normalised behaviour log, as produced by every adapter.
#   user_id   bigint   user key
#   item      bigint   item key
#   behaviour string   'purchase' or 'play'
#   hours     double   1.0 for a purchase, hours for a play
#   ts        timestamp  event time (order inside a user)
#   event_id  bigint   tie-break of the order
#   rkey      string   row key hashed by the deterministic split
LOG_COLUMNS = ["user_id", "item", "behaviour", "hours", "ts", "event_id", "rkey"]
