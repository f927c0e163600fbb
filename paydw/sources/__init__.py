"""Sources: staging readers, driver-table roles and the calendar generator."""

from paydw.sources.calendar import calendar, date_bounds
from paydw.sources.driver import (
    Staging,
    staging_clientes,
    staging_contratos,
    staging_from_sf,
    staging_transacoes,
    use_events,
)
from paydw.sources.staging import read_staging, read_staging_window, read_jdbc_window

__all__ = [
    "calendar", "date_bounds", "Staging", "staging_clientes", "staging_contratos",
    "staging_transacoes", "staging_from_sf", "use_events", "read_staging",
    "read_staging_window", "read_jdbc_window",
]
