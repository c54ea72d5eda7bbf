from tidewatch.sources.feeds import feed_index, granule_glob, with_source_file
from tidewatch.sources.granules import landed, read_granules
from tidewatch.sources.news import (
    granule_report,
    missing_granules,
    read_article_embeddings,
    read_articles,
    typed_articles,
    typed_embeddings,
)
from tidewatch.sources.tables import (
    country_codes,
    read_conflict,
    read_country_months,
    read_labels,
    read_many,
    read_samples,
    read_table,
)

__all__ = [
    "country_codes",
    "feed_index",
    "granule_glob",
    "granule_report",
    "landed",
    "missing_granules",
    "read_article_embeddings",
    "read_articles",
    "read_conflict",
    "read_country_months",
    "read_labels",
    "read_granules",
    "read_many",
    "read_samples",
    "read_table",
    "typed_articles",
    "typed_embeddings",
    "with_source_file",
]
