"""Schemas of the inputs, and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

EMBEDDING_WIDTH = 512
COUNTRY_COLUMNS = ["country-1", "country-2", "country-3"]

# The 27 article metadata columns in file order.
ARTICLE_COLUMNS = [
    "GKGRECORDID",
    "DATE",
    "SourceCollectionIdentifier",
    "SourceCommonName",
    "DocumentIdentifier",
    "Counts",
    "V2Counts",
    "Themes",
    "V2Themes",
    "Locations",
    "V2Locations",
    "Persons",
    "V2Persons",
    "Organizations",
    "V2Organizations",
    "V2Tone",
    "Dates",
    "GCAM",
    "SharingImage",
    "RelatedImages",
    "SocialImageEmbeds",
    "SocialVideoEmbeds",
    "Quotations",
    "AllNames",
    "Amounts",
    "TranslationInfo",
    "Extras",
]

# The columns later stages read; everything else is dropped unless asked for.
ARTICLE_KEPT = [
    "GKGRECORDID",
    "SourceCommonName",
    "DocumentIdentifier",
    "V2Counts",
    "V2Themes",
    "V2Locations",
    "V2Persons",
    "V2Organizations",
]

ARTICLE_INTEGER_COLUMNS = {"DATE": "bigint", "SourceCollectionIdentifier": "int"}

EMBEDDING_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("docembed", T.ArrayType(T.FloatType())),
    ]
)

CONFLICT_SCHEMA = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("Month", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("Fatalities", T.LongType()),
    ]
)

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("fatalities", T.LongType()),
        T.StructField("trend", T.DoubleType()),
        T.StructField("spike", T.BooleanType()),
    ]
)

PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("embedding_window", T.StringType()),
        T.StructField("target_window", T.StringType()),
        T.StructField("fips", T.StringType()),
        T.StructField("lagged_spike", T.BooleanType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("probabilities", T.DoubleType()),
    ]
)

COUNTRY_CODE_SCHEMA = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("Fips_10", T.StringType()),
        T.StructField("iso_alpha2", T.StringType()),
        T.StructField("iso_alpha3", T.StringType()),
    ]
)

# English month names in calendar order.
MONTH_NAMES = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]

# Country names whose code is missing or spelled differently in
# the published code list.
CODE_OVERRIDES = {
    "Bailiwick of Guernsey": "GK",
    "Bailiwick of Jersey": "GE",
    "Czech Republic": "EZ",
    "Democratic Republic of Congo": "CG",
    "eSwatini": "WZ",
    "Micronesia": "FM",
    "Monaco": "MN",
    "Pitcairn": "PC",
    "Republic of Congo": "CF",
    "Saint-Barthelemy": "TB",
    "Saint-Martin": "RN",
    "South Georgia and the South Sandwich Islands": "SX",
    "South Sudan": "OD",
    "United States": "US",
}
