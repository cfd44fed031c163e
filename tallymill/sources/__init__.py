"""Readers: staging and warehouse tables, dropped CSV files, reject exports, test-data views."""
