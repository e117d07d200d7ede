"""The impression log: its columns, and the column groups the features are built from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The columns of the raw log, in file order, with their types.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("item_category_list", T.StringType()),
        T.StructField("item_property_list", T.StringType()),
        T.StructField("item_brand_id", T.LongType()),
        T.StructField("item_city_id", T.LongType()),
        T.StructField("item_price_level", T.IntegerType()),
        T.StructField("item_sales_level", T.IntegerType()),
        T.StructField("item_collected_level", T.IntegerType()),
        T.StructField("item_pv_level", T.IntegerType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_gender_id", T.IntegerType()),
        T.StructField("user_age_level", T.IntegerType()),
        T.StructField("user_occupation_id", T.IntegerType()),
        T.StructField("user_star_level", T.IntegerType()),
        T.StructField("context_id", T.LongType()),
        T.StructField("context_timestamp", T.LongType()),
        T.StructField("context_page_id", T.IntegerType()),
        T.StructField("predict_category_property", T.StringType()),
        T.StructField("shop_id", T.LongType()),
        T.StructField("shop_review_num_level", T.IntegerType()),
        T.StructField("shop_review_positive_rate", T.DoubleType()),
        T.StructField("shop_star_level", T.IntegerType()),
        T.StructField("shop_score_service", T.DoubleType()),
        T.StructField("shop_score_delivery", T.DoubleType()),
        T.StructField("shop_score_description", T.DoubleType()),
        T.StructField("is_trade", T.IntegerType()),
    ]
)

ID = "instance_id"
LABEL = "is_trade"
EPOCH = "context_timestamp"

# The features of the baseline model.
BASELINE_FEATURES = [
    "item_id", "item_brand_id", "item_city_id", "item_price_level", "item_sales_level",
    "item_collected_level", "item_pv_level", "user_gender_id", "user_occupation_id",
    "user_age_level", "user_star_level", "user_query_day", "user_query_day_hour",
    "context_page_id", "hour", "shop_id", "shop_review_num_level", "shop_star_level",
    "shop_review_positive_rate", "shop_score_service", "shop_score_delivery", "shop_score_description",
]

ITEM_LEVELS = [
    "item_brand_id", "item_city_id", "item_price_level",
    "item_sales_level", "item_collected_level", "item_pv_level",
]
USER_LEVELS = ["user_gender_id", "user_age_level", "user_occupation_id", "user_star_level"]
SHOP_LEVELS = ["shop_id", "shop_review_num_level", "shop_star_level"]
SHOP_MEASURES = [
    "shop_score_service", "shop_score_delivery", "shop_score_description",
    "shop_review_positive_rate", "shop_star_level", "shop_review_num_level",
]

# What a missing -1 is replaced with, per column.
SENTINEL_REPLACEMENTS = {
    "user_age_level": (-1, 1003),
    "user_gender_id": (-1, 0),
    "user_occupation_id": (-1, 2005),
    "user_star_level": (-1, 3006),
    "item_sales_level": (-1, 12),
}

# The columns treated as categories by the point-in-time model. The first
# sixteen are used alone when the list features are left out.
CATEGORY_COLUMNS = [
    "item_id", "shop_id", "user_id", "user_gender_id", "user_age_level",
    "user_occupation_id", "user_star_level", "item_brand_id", "item_city_id",
    "item_price_level", "item_sales_level", "item_collected_level", "item_pv_level",
    "shop_review_num_level", "shop_star_level", "context_page_id",
    "item_category_list_1", "item_category_list_2",
    "item_property_list_0", "item_property_list_1", "item_property_list_2",
    "predict_category_0", "predict_category_1", "predict_category_2",
]

# Never features: ids, the label, raw lists and raw time.
NON_FEATURES = [
    "is_trade", "item_category_list", "item_property_list", "predict_category_property",
    "instance_id", "context_id", "realtime", "context_timestamp",
]


@dataclass(frozen=True)
class DayPlan:
    """Which days of the log are history, training, validation and unlabelled test days."""

    first: int = 18
    train: tuple[int, ...] = (21, 22, 23)
    valid: int = 24
    test: int = 25

    @property
    def label_days(self) -> tuple[int, ...]:
        return (*self.train, self.valid, self.test)
