"""Explicit schemas for every landed payload and every engine output.

No schema inference anywhere: inference is slow on large inputs and, for the
nested board payloads, not even well defined.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()
L = T.LongType()
I = T.IntegerType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---------------------------------------------------------------- schedule
# Names and order of the payload's fields. Every leaf of the schedule record is text there.
DEPARTURE = _struct(("airport", S), ("timezone", S), ("iata", S), ("icao", S),
                    ("terminal", S), ("gate", S), ("delay", S), ("scheduled", S),
                    ("estimated", S), ("actual", S), ("estimated_runway", S),
                    ("actual_runway", S))
ARRIVAL = _struct(("airport", S), ("timezone", S), ("iata", S), ("icao", S),
                  ("terminal", S), ("gate", S), ("baggage", S), ("delay", S),
                  ("scheduled", S), ("estimated", S), ("actual", S),
                  ("estimated_runway", S), ("actual_runway", S))
AIRLINE = _struct(("name", S), ("iata", S), ("icao", S))
FLIGHT = _struct(("number", S), ("iata", S), ("icao", S), ("codeshared", S))
SCHEDULE_RECORD = _struct(("flight_date", S), ("flight_status", S),
                          ("departure", DEPARTURE), ("arrival", ARRIVAL),
                          ("airline", AIRLINE), ("flight", FLIGHT),
                          ("aircraft", S), ("live", S))
PAGINATION = _struct(("limit", L), ("offset", L), ("count", L), ("total", L))
SCHEDULE_ENVELOPE = _struct(("pagination", PAGINATION),
                            ("data", T.ArrayType(SCHEDULE_RECORD)))

# Nested path -> flat column name of the planner table.
SCHEDULE_COLUMNS = {
    "flight_date": "flight_date",
    "flight_status": "flight_status",
    "departure.airport": "departure_airport",
    "departure.iata": "departure_iata",
    "departure.icao": "departure_icao",
    "departure.scheduled": "departure_scheduled",
    "departure.estimated": "departure_estimated",
    "arrival.airport": "arrival_airport",
    "arrival.iata": "arrival_iata",
    "arrival.icao": "arrival_icao",
    "arrival.scheduled": "arrival_scheduled",
    "arrival.estimated": "arrival_estimated",
    "airline.name": "airline_name",
    "airline.iata": "airline_iata",
    "airline.icao": "airline_icao",
    "flight.number": "flight_number",
    "flight.iata": "flight_iata",
    "flight.icao": "flight_icao",
}

# ---------------------------------------------------------------- airports (D3)
# The columns of the headerless comma-separated file; `\N` marks a missing value.
AIRPORTS_CSV = _struct(("airport_id", I), ("name", S), ("city", S), ("country", S),
                       ("iata", S), ("icao", S), ("latitude", D), ("longitude", D),
                       ("altitude", I), ("timezone", S), ("dst", S), ("tz", S),
                       ("type", S), ("source", S))
AIRPORTS_DROPPED = ("type", "source")

BUSY_AIRPORTS = _struct(("name", S), ("iata", S))

# ---------------------------------------------------------------- board
# Names of the payload's fields.
_EPOCHS = _struct(("departure", L), ("arrival", L))
BOARD_FLIGHT = _struct(
    ("identification", _struct(("id", S), ("callsign", S))),
    ("airline", _struct(("name", S))),
    ("airport", _struct(("origin", _struct(("name", S))),
                        ("destination", _struct(("name", S))))),
    ("time", _struct(("scheduled", _EPOCHS), ("real", _EPOCHS), ("estimated", _EPOCHS))),
)
BOARD_ENTRY = _struct(("flight", BOARD_FLIGHT))
_BOARD_LIST = _struct(("data", T.ArrayType(BOARD_ENTRY)))
BOARD_PAYLOAD = _struct(
    ("airport", _struct(
        ("code", S),
        ("page", L),
        ("pluginData", _struct(("schedule", _struct(("arrivals", _BOARD_LIST),
                                                    ("departures", _BOARD_LIST))))))),
)

# The dotted keys the board display reads (flattened with `.` -> `_`).
BOARD_KEYS = [
    "flight.identification.id",
    "flight.identification.callsign",
    "flight.airline.name",
    "flight.airport.origin",
    "flight.airport.destination",
    "flight.time.scheduled",
    "flight.time.real",
    "flight.time.estimated",
]

# ---------------------------------------------------------------- flight detail
# Names of the payload's fields.
TRAIL_FIX = _struct(("lat", D), ("lng", D), ("alt", I), ("spd", I), ("ts", L), ("hd", I))
_POSITION = _struct(("latitude", D), ("longitude", D), ("altitude", D),
                    ("country", _struct(("name", S))))
_DETAIL_AIRPORT = _struct(("name", S), ("code", _struct(("iata", S))), ("position", _POSITION))
FLIGHT_DETAIL = _struct(
    ("identification", _struct(("id", S), ("callsign", S))),
    ("aircraft", _struct(("model", _struct(("text", S), ("code", S))))),
    ("airline", _struct(("name", S))),
    ("airport", _struct(("origin", _DETAIL_AIRPORT), ("destination", _DETAIL_AIRPORT))),
    ("time", _struct(("scheduled", _EPOCHS), ("real", _EPOCHS), ("estimated", _EPOCHS),
                     ("historical", _struct(("flighttime", S), ("delay", S))))),
    ("trail", T.ArrayType(TRAIL_FIX)),
)

# Detail path -> flat field name (P7), in the order the tracker reads them.
DETAIL_COLUMNS = {
    "identification.id": "id",
    "identification.callsign": "callsign",
    "aircraft.model.text": "aircraft_modelname",
    "aircraft.model.code": "aircraft_modelcode",
    "airline.name": "airline_name",
    "airport.origin.name": "origin_airport_name",
    "airport.origin.code.iata": "origin_airport_iata",
    "airport.origin.position.latitude": "origin_airport_lat",
    "airport.origin.position.longitude": "origin_airport_lon",
    "airport.origin.position.altitude": "origin_airport_alt",
    "airport.origin.position.country.name": "origin_airport_country",
    "airport.destination.name": "destination_airport_name",
    "airport.destination.code.iata": "destination_airport_iata",
    "airport.destination.position.latitude": "destination_airport_lat",
    "airport.destination.position.longitude": "destination_airport_lon",
    "airport.destination.position.altitude": "destination_airport_alt",
    "airport.destination.position.country.name": "destination_airport_country",
    "time.scheduled.departure": "scheduled_departure_time",
    "time.scheduled.arrival": "scheduled_arrival_time",
    "time.real.departure": "real_departure_time",
    "time.real.arrival": "real_arrival_time",
    "time.estimated.departure": "estimated_departure_time",
    "time.estimated.arrival": "estimated_arrival_time",
    "time.historical.flighttime": "historical_flighttime",
    "time.historical.delay": "historical_delay",
}

# ---------------------------------------------------------------- weather
# Hourly variables in the order the provider returns them.
WEATHER_METRICS = ["cloud_cover", "cloud_cover_high", "precipitation", "snow_depth",
                   "visibility", "weather_code", "lifted_index"]
# The metrics that are scored against history.
SCORED_METRICS = ["precipitation", "visibility", "snow_depth"]
WEATHER_PAYLOAD = _struct(
    ("latitude", D), ("longitude", D),
    ("hourly", _struct(("time", T.ArrayType(L)),
                       *[(m, T.ArrayType(D)) for m in WEATHER_METRICS])),
)

# ---------------------------------------------------------------- planner output
PATH_POINT = _struct(("idx", I), ("lat", D), ("lon", D), ("t", L))
PATH = T.ArrayType(PATH_POINT)
