"""Explicit schemas of the tables and topics. Nothing is inferred."""

from pyspark.sql import types as T

LINE = T.StructType([T.StructField("line", T.StringType())])

CLEAN_POST = T.StructType(
    [
        T.StructField("tweetId", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("tweetType", T.StringType()),
        T.StructField("tweetTimestamp", T.LongType()),
        T.StructField("authorId", T.StringType()),
        T.StructField("authorFollowerCount", T.LongType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("hasMedia", T.BooleanType()),
    ]
)

# Order of arrival: the offset of a Kafka topic, or publishing and place in a folder topic.
VERSION = T.DecimalType(38, 0)

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("version", VERSION),
    ]
)

POINT = T.StructType(
    [T.StructField("point_id", T.StringType())]
    + CLEAN_POST.fields
    + [T.StructField("embedding", T.ArrayType(T.FloatType()))]
)

PROFILE = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("profile", T.ArrayType(T.FloatType())),
        T.StructField("interestCount", T.IntegerType()),
        T.StructField("vectorDim", T.IntegerType()),
        T.StructField("reason", T.StringType()),
    ]
)

# Columns the CSV adapter looks at; any of them may be missing from a file.
CSV_COLUMNS = [
    "id",
    "user_posted",
    "name",
    "description",
    "date_posted",
    "hashtags",
    "followers",
    "following",
    "is_verified",
    "external_url",
    "photos",
    "videos",
    "quoted_post",
    "parent_post_details",
]
