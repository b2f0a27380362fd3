"""CSV export of both final tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberscope.functions.links import with_links
from emberscope.sources.files import in_order, write_csv

DETECTION_ORDER = ["area_include_id", "event_no", "acq_date"]
EVENT_ORDER = ["area_include_id", "event_no", "start_date"]


def export(
    detections: DataFrame,
    events: DataFrame,
    path: str,
    add_links: bool = False,
    date_buffer_days: int = 3,
) -> None:
    """Write ``output`` and ``output_clustered`` below ``path``.

    Links are made of the sorted rows: they are far longer than all else, and the sort
    would move them.
    """
    for df, folder, order in (
        (detections, "output", DETECTION_ORDER),
        (events, "output_clustered", EVENT_ORDER),
    ):
        rows = in_order(df, order)
        write_csv(with_links(rows, date_buffer_days=date_buffer_days) if add_links else rows, f"{path}/{folder}")
