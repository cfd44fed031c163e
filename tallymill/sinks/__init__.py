"""Writers: quarantine, warehouse tables, audit log and data-quality report."""
