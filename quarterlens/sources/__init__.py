"""Sources (driver tables -> bronze billing tables) and sinks (gold marts)."""

from quarterlens.sources.driver import (  # noqa: F401
    bronze_customers,
    bronze_invoices,
    bronze_subscriptions,
    bronze_usage_events,
    monthly_snapshots,
    read_bronze,
    read_table,
    subscription_changes,
)
from quarterlens.sources.marts import (  # noqa: F401
    mart_path,
    read_mart,
    write_close_report,
    write_mart,
)
