"""Declared record shapes."""

from pyspark.sql import types as T

CAPTIONS = T.StructType(
    [
        T.StructField("image_id", T.LongType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("caption_id", T.LongType()),
        T.StructField("caption", T.StringType()),
        T.StructField("coco_url", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("split", T.StringType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("pixel_values", T.ArrayType(T.FloatType(), False)),
        T.StructField("labels", T.ArrayType(T.IntegerType(), False)),
    ]
)

LENGTHS = T.StructType(
    [T.StructField("caption_id", T.LongType()), T.StructField("length", T.IntegerType())]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("predicted_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
    ]
)

# Raw caption columns that no model input needs.
RAW_COLUMNS = [
    "image_path",
    "caption_id",
    "caption",
    "coco_url",
    "file_name",
    "height",
    "width",
]
