"""They define the results and must not be tuned."""

# Station ids of the published feeds carry this prefix in telemetry and gold tables.
STATION_ID_PREFIX = "motivate_BOS_"

# "Local" time is a fixed four hours behind UTC, all year round.
LOCAL_OFFSET_ZONE = "UTC+4"
LOCAL_OFFSET_SECONDS = 4 * 3600

# Landing files are named <feed>_<capture time>[_<run id>].json
CAPTURE_TIME_FORMAT = "yyyyMMddHHmmss"
TELEMETRY_FEED = "ebikes_at_station"
STATION_INFORMATION_FEED = "station_information"
STATION_STATUS_FEED = "station_status"

# A gap between two readings of a bike must exceed this to count as a trip.
MIN_TRIP_SECONDS = 60

# Trip duration buckets: (upper bound in seconds, exclusive; label).
DURATION_BUCKETS = ((600, "0-10 minutes"), (1800, "10-30 minutes"), (3600, "30-60 minutes"))
DURATION_OVERFLOW = "60+ minutes"

# Moved by staff: charge or range between the pickup value and this much more.
REBALANCE_BATTERY_GAIN = 9.9
REBALANCE_RANGE_GAIN = 3.49

# Serviced: charge or range grew by at least this much.
MAINTENANCE_BATTERY_GAIN = 10
MAINTENANCE_RANGE_GAIN = 3.5

# Names of the validity columns of a type 2 history.
START_AT = "__START_AT"
END_AT = "__END_AT"
