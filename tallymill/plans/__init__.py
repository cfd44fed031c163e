"""End-to-end queries: star-schema reports, data checks and the staging-to-warehouse run."""
