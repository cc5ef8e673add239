"""Column expressions; none of them uses a Python UDF."""

from fraudlake.functions.geo import haversine_km
from fraudlake.functions.ids import alert_id
from fraudlake.functions.times import day_of, days_before, epoch_seconds, parse_event_time

__all__ = ["alert_id", "day_of", "days_before", "epoch_seconds", "haversine_km", "parse_event_time"]
