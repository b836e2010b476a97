"""fettle: fine-tuning data preparation, scoring and run analysis on Spark."""
