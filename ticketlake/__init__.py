"""PySpark library for service-desk, inventory and ticket-text analytics."""
