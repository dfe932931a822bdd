"""Business constants of the trip-pricing domain.

Fixed values: these must equal the published rules for results to match
(fare sanity bounds, city bounding box, airport coordinates, fare bands,
drift / alert / promotion thresholds, cost weights). They are kept
together, in natural order, in one frozen dataclass so every operator can
take an override (``params=TripRules(max_fare=250.0)``) instead of a
hidden global.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
REQUIRED_COLUMNS = (
    "fare_amount",
    "pickup_datetime",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "passenger_count",
)
TARGET = "fare_amount"
ID_COLUMNS = ("key", "unnamed_0", "id")

EARTH_RADIUS_KM = 6371.0088
EARTH_RADIUS_KM_SIMPLE = 6371.0
KM_TO_MILES = 0.621371

JFK = (40.6413, -73.7781)
LGA = (40.7769, -73.8740)
EWR = (40.6895, -74.1745)
MANHATTAN_CENTER = (40.7580, -73.9855)
AIRPORT_RADIUS_KM = 2.0

RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)
LATE_NIGHT_HOURS = (23, 0, 1, 2, 3, 4)
LOCAL_TZ = "America/New_York"

# band name, low (inclusive), high (exclusive)
FARE_BANDS = (
    ("LOW", 0.0, 10.0),
    ("MEDIUM", 10.0, 30.0),
    ("HIGH", 30.0, 70.0),
    ("PREMIUM", 70.0, 10000.0),
)
FALLBACK_BAND = "PREMIUM"
FALLBACK_FARE = 15.0

FLAG_AIRPORT = "AIRPORT_FLAT_CANDIDATE"
FLAG_SURGE = "SURGE_ELIGIBLE"
FLAG_NORMAL = "NORMAL"
SURGE_MIN_DISTANCE_KM = 5.0

PSI_MODERATE = 0.10
PSI_HIGH = 0.20
MAPE_ALERT = 0.25
SURGE_RATE_ALERT = 0.30

MIN_RMSE_IMPROVEMENT = 0.02
MIN_R2 = 0.80
MAX_GAP = 0.15

UNDER_PRICE_COST = 1.00
OVER_PRICE_COST = 0.35

CLIP_FOLD = 1.5
ORDINAL_THRESHOLD = 10
SKEW_THRESHOLD = 0.8
SELECT_K = 12
CV_FOLDS = 5
SEARCH_ITERS = 20
RANDOM_STATE = 42
NEVER_POWER_TRANSFORM = (
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "bearing_deg",
)
ROLE_EXCLUDE = ("fare_amount", "pickup_datetime", "pickup_year")

# model-selection tiers: (max train/test gap, max cv_std/cv_mean, min test R2)
SELECTION_TIERS = (
    (0.03, 0.10, 0.90),
    (0.06, 0.15, 0.85),
    (0.10, 0.20, 0.80),
    (0.20, 1.00, 0.00),
)
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class TripRules:
    """Validation and pricing parameters (defaults = the fixed values)."""

    min_fare: float = 2.50
    max_fare: float = 300.00
    min_passengers: int = 1
    max_passengers: int = 6
    min_lat: float = 40.40
    max_lat: float = 41.20
    min_lon: float = -74.60
    max_lon: float = -72.80
    max_trip_km: float = 100.0
    min_rows: int | None = 500
    airports: tuple = field(default=(("jfk", JFK), ("lga", LGA), ("ewr", EWR)))
    airport_radius_km: float = AIRPORT_RADIUS_KM
    tz: str = LOCAL_TZ


DEFAULT_RULES = TripRules()
