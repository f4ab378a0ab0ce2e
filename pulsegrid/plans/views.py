"""Tables and standing views by name, for questions asked in SQL."""

from __future__ import annotations

from ..sources.tables import TableStore
from .anomalies import active_anomalies
from .infrastructure import recent_application_performance, recent_server_health
from .rollups import FROM_STATES, hourly_from_states


def register_views(store: TableStore) -> None:
    """Make the tables, the hourly rollups and the standing views available to ``spark.sql``.

    All of them look at what is stored when a question is asked, so one registration lasts. The
    views look back from that moment.
    """
    store.register()
    views = {name: hourly_from_states(store, name) for name in FROM_STATES} | {
        "recent_server_health": recent_server_health(store.read("server_metrics")),
        "recent_application_performance": recent_application_performance(
            store.read("application_metrics")
        ),
        "active_anomalies": active_anomalies(store.read("anomalies")),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
