"""Fixed schemas; no operation infers one."""

from pyspark.sql import types as T

CLICK = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("url", T.StringType()),
    ]
)

WORD = T.StructType([T.StructField("word", T.StringType())])

WORD_FREQUENCY = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("frequency", T.LongType()),
    ]
)

ORDER_LINE = T.StructType(
    [
        T.StructField("user", T.LongType()),
        T.StructField("product", T.StringType()),
        T.StructField("amount", T.IntegerType()),
    ]
)

PRICE = T.StructType(
    [
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("currency", T.StringType()),
        T.StructField("ts6", T.TimestampType()),
    ]
)

KEY_RECORD = T.StructType(
    [
        T.StructField("boy", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)

EDIT = T.StructType(
    [
        T.StructField("user", T.StringType()),
        T.StructField("byte_diff", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

BOOK = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("title", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("qty", T.IntegerType()),
    ]
)

ACCOUNT = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("active", T.BooleanType()),
    ]
)

KAFKA_ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
