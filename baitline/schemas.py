"""Table shapes shared by sources and operators."""

from pyspark.sql import types as T

ATTACHMENT = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("extension", T.StringType()),
    T.StructField("size_kb", T.DoubleType()),
    T.StructField("mime_type", T.StringType()),
])

EMAIL = T.StructType([
    T.StructField("email_id", T.StringType()),
    T.StructField("sender_email", T.StringType()),
    T.StructField("sender_name", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("body_text", T.StringType()),
    T.StructField("urls", T.ArrayType(T.StringType())),
    T.StructField("attachments", T.ArrayType(ATTACHMENT)),
    T.StructField("page_source", T.StringType()),
])

TRAINING_COLUMNS = [
    "sender_email", "sender_name", "subject", "body_text", "urls", "attachments", "label",
]

LABELLED_URL = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("y_true", T.IntegerType()),
])

PREDICTION = T.StructType([
    T.StructField("y_true", T.IntegerType()),
    T.StructField("y_pred", T.IntegerType()),
])

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("content", T.BinaryType()),
])
