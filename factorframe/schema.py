"""Column names, schemas and fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the ratings data, as its files spell them.
ITEM = "MOVIE_ID"
USER = "CUST_ID"
RATING = "RATING"
DATE = "DATE"
YEAR = "year"
MONTH = "month"

RATING_KEY = (ITEM, USER, DATE)
PARTITION_COLS = (YEAR, MONTH)

# Rating domain, drift thresholds and weights, model defaults,
# request limits, job states, result lifetime.
RATING_VALUES = (1, 2, 3, 4, 5)
KL_EPSILON = 1e-10
KL_THRESHOLD, MEAN_SHIFT_THRESHOLD, MEDIAN_SHIFT_THRESHOLD = 0.1, 0.2, 0.5
KL_WEIGHT, MEAN_WEIGHT, MEDIAN_WEIGHT = 0.5, 0.3, 0.2
RETRAIN_SCORE = 1.0
ALS_RANK, ALS_REG, ALS_MAX_ITER = 64, 0.1, 15
FOLD_IN_LAMBDA = 0.1
RANKING_K, RELEVANCE_THRESHOLD = 10, 4.0
TOP_K_FALLBACK = 10
REQUEST_K_DEFAULT, REQUEST_K_MIN, REQUEST_K_MAX = 20, 1, 500
RESULT_TTL_SECONDS = 3600
PENDING, RUNNING, DONE, FAILED = "PENDING", "RUNNING", "DONE", "FAILED"
REQUEST_TOPIC, RESULT_TOPIC = "recs.requests", "recs.results"

#: Ratings before their date is typed.
RAW_RATINGS = T.StructType(
    [
        T.StructField(ITEM, T.IntegerType()),
        T.StructField(USER, T.IntegerType()),
        T.StructField(RATING, T.IntegerType()),
        T.StructField(DATE, T.StringType()),
    ]
)

#: Arriving rating files: CSV with a header, columns in this order.
ARRIVALS_CSV = T.StructType(
    [
        T.StructField(DATE, T.StringType()),
        T.StructField(USER, T.IntegerType()),
        T.StructField(ITEM, T.IntegerType()),
        T.StructField(RATING, T.IntegerType()),
    ]
)

#: Body of a recommendation request.
REQUEST = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField(
            "feedback",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("item_id", T.LongType()),
                        T.StructField("rating", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("k", T.IntegerType()),
        T.StructField("exclude_item_ids", T.ArrayType(T.LongType())),
        T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    ]
)

#: One message on the request topic.
JOB = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("requested_at", T.TimestampType()),
        T.StructField("request", REQUEST),
    ]
)

RESULT_ITEMS = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)

#: One message on the result topic.
RESULT = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("items", RESULT_ITEMS),
        T.StructField("error", T.StringType()),
        T.StructField("context", T.MapType(T.StringType(), T.StringType())),
    ]
)
