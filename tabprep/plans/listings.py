"""Clean-up of a listings table from currency text to imputed numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabprep.operators import clean
from tabprep.operators.impute import impute_median
from tabprep.session import shared_path
from tabprep.sources.tables import overwrite_table, read_table

# The columns kept of a listings file, and those that get imputed.
LISTING_COLUMNS = [
    "host_is_superhost",
    "instant_bookable",
    "host_total_listings_count",
    "neighbourhood_cleansed",
    "latitude",
    "longitude",
    "property_type",
    "room_type",
    "accommodates",
    "bathrooms",
    "bedrooms",
    "beds",
    "minimum_nights",
    "number_of_reviews",
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
    "price",
]
IMPUTED_COLUMNS = [
    "bedrooms",
    "bathrooms",
    "beds",
    "review_scores_rating",
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
]


def clean_listings(
    df: DataFrame,
    columns: Sequence[str] = tuple(LISTING_COLUMNS),
    imputed: Sequence[str] = tuple(IMPUTED_COLUMNS),
    price: str = "price",
    price_range: tuple[float, float] = (clean.PRICE_LOW, clean.PRICE_HIGH),
    nights: str = "minimum_nights",
    max_nights: float = clean.MAX_NIGHTS,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Project, parse the price, cut outliers, cast all numbers but ``keys``, flag and impute by median.

    Projection and filters are narrow. Texts are parsed once: the cleaned rows go to the shared folder,
    the passes that look for medians read only the imputed columns of those, and missing values
    are filled as the result is read.
    """
    rows = clean.clean_currency(clean.select_columns(df, columns), price)
    rows = clean.filter_open_range(rows, price, *price_range)
    rows = clean.filter_upper_bound(rows, nights, max_nights)
    rows = clean.add_missing_flags(clean.cast_numbers_to_double(rows, spare=keys), imputed)
    landed = overwrite_table(rows, shared_path(df.sparkSession, "cleaned"))
    return impute_median(read_table(df.sparkSession, landed), imputed)
