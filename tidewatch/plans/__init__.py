from tidewatch.plans.jobs import (
    country_mean_files,
    country_month_means,
    forecast_scores,
    ingest_days,
    label_panel,
    predict_spikes,
    spike_dataset,
    stack_months,
    tagged_articles,
    training_samples,
    unique_embeddings,
)

__all__ = [
    "country_mean_files",
    "country_month_means",
    "forecast_scores",
    "ingest_days",
    "label_panel",
    "predict_spikes",
    "spike_dataset",
    "stack_months",
    "tagged_articles",
    "training_samples",
    "unique_embeddings",
]
