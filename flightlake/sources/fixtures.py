"""Views of the driver's parquet tables in the engine's input shapes.

The air-traffic inputs (schedules, airports, boards, trails, weather) are not
shipped with the test data, so they are derived deterministically from the
TPC-H-style tables: ``nation`` -> airports, ``orders`` -> schedules and
boards, ``events`` -> weather hours, trails and snapshots.  Every view reads
whole tables, so its size follows the scale factor (``nation`` is a fixed
25-row dimension, like a real airport list).  ``flightlake.oracle`` holds the
same definitions as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.geo import grid_cell
from flightlake.sources.airports import BUSY_AIRPORT_LIST

# Fixed values of the fixture definitions.
E0 = 1705363200  # 2024-01-16 00:00:00 UTC
HOUR = 3600
IST_OFFSET_S = 19800  # +05:30
CELL_DEGREES = 10.0
DUPLICATED_CODES = (3, 7)
BOARD_PAGE = 100
TRAIL_CHUNK = 64
TRACK_ARRIVAL0 = 1706659200  # 2024-01-31 00:00:00 UTC


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read as it is."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    # The input files are immutable: after the first read, skip schema discovery.
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows to tasks by key, always: a driver table may be one row group, and what is derived from its rows
    (payload text, paths) costs far more than moving their few columns."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def _epoch(ts: str = "ts") -> Column:
    """Epoch seconds of a driver timestamp (stored without zone, read as UTC)."""
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _iso(epoch: Column, variant: Column) -> Column:
    """Schedule time text in three styles: naive, ``+00:00`` and local ``+05:30``."""
    fmt_t = "yyyy-MM-dd'T'HH:mm:ss"
    return (F.when(variant == 0, F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd HH:mm:ss"))
            .when(variant == 1, F.concat(F.date_format(F.timestamp_seconds(epoch), fmt_t),
                                         F.lit("+00:00")))
            .otherwise(F.concat(F.date_format(F.timestamp_seconds(epoch + F.lit(IST_OFFSET_S)),
                                              fmt_t), F.lit("+05:30"))))


# ------------------------------------------------------------------ airports
def airports_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension from ``nation``; codes 3 and 7 appear twice (ambiguous)."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")

    def rows(dup: bool) -> DataFrame:
        src = n.filter(k.isin(*DUPLICATED_CODES)) if dup else n
        return src.select(
            (k + F.lit(1000) if dup else k).cast("int").alias("airport_id"),
            (F.concat(F.col("n_name"), F.lit("_DUP")) if dup else F.col("n_name")).alias("name"),
            F.concat(F.lit("City "), k, F.lit(", R"), F.col("n_regionkey")).alias("city"),
            F.concat(F.lit("Country "), F.col("n_regionkey")).alias("country"),
            k.cast("string").alias("iata"),
            F.concat(F.lit("ICAO"), k).alias("icao"),
            (F.lit(0.0) if dup else ((k * 37) % 121 - 60).cast("double")).alias("latitude"),
            (F.lit(0.0) if dup else ((k * 53) % 301 - 150).cast("double")).alias("longitude"),
            (k * 10).cast("int").alias("altitude"),
            F.lit("0").alias("timezone"),
            F.lit("U").alias("dst"),
            F.lit("Etc/UTC").alias("tz"),
            F.lit("airport").alias("type"),
            F.lit("fixture").alias("source"),
        )

    return rows(False).unionByName(rows(True))


def airport_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The airport dimension rendered as headerless CSV lines (``\\N`` = null)."""
    a = airports_v(spark, sf_dir)
    return a.select(F.to_csv(F.struct(*a.columns), {"nullValue": "\\N"}).alias("line"))


# ------------------------------------------------------------------ schedules
def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders"), "o_orderkey")
    dep_e = F.lit(E0) + (F.col("o_orderkey") % 240) * HOUR
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        dep_e.alias("dep_e"),
        (dep_e + ((F.col("o_orderkey") % 11) - 1) * HOUR).alias("arr_e"),
        (F.col("o_custkey") % 27).alias("dep_code"),
        ((F.col("o_orderkey") * 7) % 25).alias("arr_code"),
    )


def schedule_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18-column flat schedule, with noisy whitespace and mixed time styles.

    Status: ``O`` -> scheduled, ``F`` -> landed, ``P`` -> missing.  Departure
    codes 25 and 26 are unknown airports; some legs arrive before departing.
    """
    o = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    pad = (F.when(key % 4 == 0, F.lit("  ")).when(key % 4 == 1, F.lit("\t"))
           .when(key % 4 == 2, F.lit(" \u00a0 ")).otherwise(F.lit(" ")))
    variant = key % 3
    return o.select(
        F.date_format(F.timestamp_seconds("dep_e"), "yyyy-MM-dd").alias("flight_date"),
        F.when(F.col("o_orderstatus") == "O", F.lit("scheduled"))
         .when(F.col("o_orderstatus") == "F", F.lit("landed")).alias("flight_status"),
        F.concat(F.lit("Airport"), pad, F.col("dep_code"), F.lit(" ")).alias("departure_airport"),
        F.col("dep_code").cast("string").alias("departure_iata"),
        F.concat(F.lit("ICAO"), F.col("dep_code")).alias("departure_icao"),
        _iso(F.col("dep_e"), variant).alias("departure_scheduled"),
        F.lit(None).cast("string").alias("departure_estimated"),
        F.concat(F.lit(" Airport"), pad, F.col("arr_code")).alias("arrival_airport"),
        F.col("arr_code").cast("string").alias("arrival_iata"),
        F.concat(F.lit("ICAO"), F.col("arr_code")).alias("arrival_icao"),
        _iso(F.col("arr_e"), variant).alias("arrival_scheduled"),
        F.lit(None).cast("string").alias("arrival_estimated"),
        F.col("o_orderpriority").alias("airline_name"),
        F.concat(F.lit("A"), F.substring("o_orderpriority", 1, 1)).alias("airline_iata"),
        F.concat(F.lit("AL"), F.substring("o_orderpriority", 1, 1)).alias("airline_icao"),
        key.cast("string").alias("flight_number"),
        F.concat(F.lit("FL"), key).alias("flight_iata"),
        F.concat(F.lit("FLT"), key).alias("flight_icao"),
    )


def schedule_repeats_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule with flight numbers as they come: some null, the others used by several legs."""
    k = F.col("flight_number").cast("long")
    return schedule_v(spark, sf_dir).withColumn(
        "flight_iata", F.when(k % 17 != 0, F.concat(F.lit("FL"), k % 500)))


def schedule_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule rows nested back into the landed record shape (plus page number)."""
    s = schedule_v(spark, sf_dir)
    page = (F.col("flight_number").cast("long") / F.lit(BOARD_PAGE)).cast("long")
    return s.select(
        page.alias("page"),
        F.col("flight_number").cast("long").alias("_k"),
        F.struct(
            F.col("flight_date"), F.col("flight_status"),
            F.struct(F.col("departure_airport").alias("airport"), F.lit("UTC").alias("timezone"),
                     F.col("departure_iata").alias("iata"), F.col("departure_icao").alias("icao"),
                     F.lit(None).cast("string").alias("terminal"),
                     F.lit(None).cast("string").alias("gate"),
                     F.lit(None).cast("string").alias("delay"),
                     F.col("departure_scheduled").alias("scheduled"),
                     F.col("departure_estimated").alias("estimated"),
                     F.lit(None).cast("string").alias("actual"),
                     F.lit(None).cast("string").alias("estimated_runway"),
                     F.lit(None).cast("string").alias("actual_runway")).alias("departure"),
            F.struct(F.col("arrival_airport").alias("airport"), F.lit("UTC").alias("timezone"),
                     F.col("arrival_iata").alias("iata"), F.col("arrival_icao").alias("icao"),
                     F.lit(None).cast("string").alias("terminal"),
                     F.lit(None).cast("string").alias("gate"),
                     F.lit(None).cast("string").alias("baggage"),
                     F.lit(None).cast("string").alias("delay"),
                     F.col("arrival_scheduled").alias("scheduled"),
                     F.col("arrival_estimated").alias("estimated"),
                     F.lit(None).cast("string").alias("actual"),
                     F.lit(None).cast("string").alias("estimated_runway"),
                     F.lit(None).cast("string").alias("actual_runway")).alias("arrival"),
            F.struct(F.col("airline_name").alias("name"), F.col("airline_iata").alias("iata"),
                     F.col("airline_icao").alias("icao")).alias("airline"),
            F.struct(F.col("flight_number").alias("number"), F.col("flight_iata").alias("iata"),
                     F.col("flight_icao").alias("icao"),
                     F.lit(None).cast("string").alias("codeshared")).alias("flight"),
            F.lit(None).cast("string").alias("aircraft"),
            F.lit(None).cast("string").alias("live"),
        ).alias("record"),
    )


def schedule_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed schedule envelopes as JSON text, one page of at most 100 records each."""
    r = schedule_records(spark, sf_dir)
    pages = r.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("_k", "record"))).alias("_rs"),
        F.count(F.lit(1)).alias("_n"))
    env = F.struct(
        F.struct(F.lit(BOARD_PAGE).cast("long").alias("limit"),
                 (F.col("page") * BOARD_PAGE).cast("long").alias("offset"),
                 F.col("_n").cast("long").alias("count"),
                 F.lit(None).cast("long").alias("total")).alias("pagination"),
        F.transform("_rs", lambda x: x["record"]).alias("data"))
    return pages.select(F.to_json(env).alias("payload"))


# ------------------------------------------------------------------ weather
def weather_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather per grid cell from ``events``, placed like the trail fixes; hour of ``ts``."""
    e = table(spark, sf_dir, "events")
    epoch = _epoch("ts")
    i = F.col("event_id")
    return (e.select(fixture_cell(((i * 13) % 121 - 60).cast("double"), ((i * 29) % 301 - 150).cast("double"))
                     .alias("cell"),
                     (epoch - F.pmod(epoch, F.lit(HOUR))).alias("ts_hour"),
                     "value")
            .groupBy("cell", "ts_hour")
            .agg(F.round(F.sum("value"), 2).alias("precipitation"),
                 F.round(F.max("value"), 2).alias("visibility"),
                 F.round(F.min("value"), 2).alias("snow_depth")))


def fixture_cell(lat: str | Column = "lat", lon: str | Column = "lon") -> Column:
    """Waypoint -> weather cell: the production grid, 10 degrees wide (``events`` are too few for 0.25)."""
    return grid_cell(lat, lon, CELL_DEGREES)


def weather_pulls_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping pulls of the hourly weather: 1 holds all hours, 0 stale values of
    every other hour, 2 newer values of every third hour; pull 1 is landed twice."""
    w = weather_v(spark, sf_dir)
    hour = (F.col("ts_hour") / F.lit(HOUR)).cast("long")
    first = w.withColumn("pull", F.lit(1).cast("long"))
    stale = w.where(hour % 2 == 0).withColumns({"precipitation": F.col("precipitation") - 5, "pull": F.lit(0).cast("long")})
    newer = w.where(hour % 3 == 0).withColumns({"precipitation": F.col("precipitation") + 1, "pull": F.lit(2).cast("long")})
    return first.unionByName(stale).unionByName(newer).unionByName(first)


def weather_issues_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of every weather hour: issued 1, 2 and 3 days before its day begins (in places of even number six
    hours later), each with other values; every fourth hour lacks the newest one."""
    w = weather_v(spark, sf_dir)
    day0 = F.col("ts_hour") - F.pmod("ts_hour", F.lit(86400))
    issues = w.withColumn("_k", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3)])))
    issues = issues.where((F.col("_k") > 1) | (F.pmod(F.floor(F.col("ts_hour") / HOUR), F.lit(4)) != 0))
    return issues.select(
        "cell", "ts_hour", (day0 - F.col("_k") * 86400 + (1 - F.col("cell") % 2) * 6 * HOUR).cast("long").alias("issue"),
        (F.col("precipitation") + F.col("_k")).alias("precipitation"), (F.col("visibility") - F.col("_k")).alias("visibility"),
        (F.col("snow_depth") + 10 * F.col("_k")).alias("snow_depth"))


def weather_points_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather points off the grid, from ``supplier``."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.cast("long").alias("station"), ((k * 37) % 181 - 90).cast("double").alias("station_lat"),
        ((k * 97) % 361 - 180).cast("double").alias("station_lon"))


def weather_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather hours packed back into per-(cell, day) parallel hourly arrays."""
    w = weather_v(spark, sf_dir)
    day = F.floor(F.col("ts_hour") / F.lit(86400))
    rows = w.groupBy("cell", day.alias("day")).agg(
        F.array_sort(F.collect_list(F.struct("ts_hour", "precipitation", "visibility",
                                             "snow_depth"))).alias("_h"))
    return rows.select("cell", "day", F.struct(
        F.col("_h.ts_hour").alias("time"),
        F.col("_h.precipitation").alias("precipitation"),
        F.col("_h.visibility").alias("visibility"),
        F.col("_h.snow_depth").alias("snow_depth")).alias("hourly"))


# ------------------------------------------------------------------ board
def board_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat airport-board entries from ``orders``."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    dep = F.lit(E0) + (k % 240) * HOUR
    return o.select(
        k.alias("pos"),
        F.when(k % 50 == 0, F.lit("")).otherwise(F.concat(F.lit("F"), k)).alias("id"),
        F.concat(F.lit("CS"), F.col("o_custkey") % 200).alias("callsign"),
        F.col("o_orderpriority").alias("airline"),
        (F.col("o_custkey") % 25).cast("string").alias("airport_code"),
        F.concat(F.lit("Origin "), (k * 7) % 25).alias("origin"),
        F.concat(F.lit("Dest "), F.col("o_custkey") % 25).alias("destination"),
        F.when(k % 2 == 0, F.lit("departures")).otherwise(F.lit("arrivals")).alias("flight_type"),
        dep.alias("sched_dep"),
        (dep + ((k % 11) + 1) * HOUR).alias("sched_arr"),
    )


def busy_board_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board entries at real codes: 50 of 60 positions carry a code of the built-in busy list."""
    codes = F.array(*[F.lit(code) for _, code in BUSY_AIRPORT_LIST])
    place = (F.col("pos") % 60).cast("int")
    return board_v(spark, sf_dir).withColumn(
        "airport_code", F.when(place < len(BUSY_AIRPORT_LIST), F.get(codes, place)).otherwise(
            F.concat(F.lit("X"), place)))


def board_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board pages as landed JSON text: per (airport, page of 100 keys) both lists."""
    return _board_pages(_paged_board(spark, sf_dir)).select("payload")


def _paged_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board entries with their page number."""
    return board_v(spark, sf_dir).withColumn("page", (F.col("pos") / F.lit(BOARD_PAGE)).cast("long"))


def _board_pages(b: DataFrame) -> DataFrame:
    """``airport_code, page, payload``.  Flat rows are dealt by page; lists and text are made where a page lies."""
    b = b.repartition("airport_code", "page")
    entry = F.struct(F.struct(
        F.struct(F.col("id"), F.col("callsign")).alias("identification"),
        F.struct(F.col("airline").alias("name")).alias("airline"),
        F.struct(F.struct(F.col("origin").alias("name")).alias("origin"),
                 F.struct(F.col("destination").alias("name")).alias("destination")).alias("airport"),
        F.struct(F.struct(F.col("sched_dep").alias("departure"),
                          F.col("sched_arr").alias("arrival")).alias("scheduled"),
                 F.struct(F.lit(None).cast("long").alias("departure"),
                          F.lit(None).cast("long").alias("arrival")).alias("real"),
                 F.struct((F.col("sched_dep") + 300).alias("departure"),
                          (F.col("sched_arr") + 300).alias("arrival")).alias("estimated"),
                 ).alias("time"),
    ).alias("flight"))

    def listed(kind: str) -> Column:
        return F.array_sort(F.collect_list(
            F.when(F.col("flight_type") == kind, F.struct(F.col("pos"), entry.alias("e")))))

    grouped = b.groupBy("airport_code", "page").agg(
        listed("arrivals").alias("_arr"), listed("departures").alias("_dep"))
    payload = F.struct(F.struct(
        F.col("airport_code").alias("code"), F.col("page"),
        F.struct(F.struct(
            F.struct(F.transform("_arr", lambda x: x["e"]).alias("data")).alias("arrivals"),
            F.struct(F.transform("_dep", lambda x: x["e"]).alias("data")).alias("departures"),
        ).alias("schedule")).alias("pluginData")).alias("airport"))
    return grouped.select("airport_code", "page", F.to_json(payload).alias("payload"))


def board_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Board pages in pulls: ``1`` has all, ``2`` all of every other airport again, ``3`` lacks the last page of
    every third airport, ``4`` is empty.  ``pages`` is an airport's number of pages."""
    b = _paged_board(spark, sf_dir)
    per = b.select("airport_code", "page").distinct().groupBy("airport_code").agg(
        F.count("*").alias("pages"), F.max("page").alias("_last"))
    code = F.col("airport_code").cast("long")
    pulls = F.array(F.lit("1"), F.lit("1"), F.when(code % 2 == 0, F.lit("2")),
                    F.when((code % 3 == 0) & (F.col("page") < F.col("_last")), F.lit("3")))
    # a page's text is made once, for all its pulls; an airport's numbers are one row of ``per``
    held = (_board_pages(b).join(F.broadcast(per), "airport_code")
            .select("payload", "pages", F.explode(pulls).alias("pull")).where(F.col("pull").isNotNull()))
    empty = F.concat(F.lit('{"airport":{"code":"'), F.col("airport_code"), F.lit('","page":0}}'))
    return held.unionByName(per.select(empty.alias("payload"), "pages", F.lit("4").alias("pull")))


# ------------------------------------------------------------------ detail / trails
def trails_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position fixes from ``events``: flight = user, one fix per event."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    return e.select(
        F.col("user_id").cast("string").alias("flight_id"),
        i.alias("event_id"),
        _epoch("ts").alias("time"),
        ((i * 13) % 121 - 60).cast("double").alias("lat"),
        ((i * 29) % 301 - 150).cast("double").alias("lng"),
        (i % 400 * 100).cast("int").alias("alt"),
        (i % 500).cast("int").alias("spd"),
        (i % 360).cast("int").alias("hd"),
    )


def trail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight-detail JSON payloads carrying the trail in chunks of 64 events.

    Inside a payload the trail is newest first; ``chunk`` orders the payloads
    of one flight (a later chunk holds later event ids).
    """
    t = trails_v(spark, sf_dir)
    chunk = (F.col("event_id") / F.lit(TRAIL_CHUNK)).cast("long")
    fix = F.struct(F.col("lat"), F.col("lng"), F.col("alt"), F.col("spd"),
                   F.col("time").alias("ts"), F.col("hd"))
    g = t.groupBy("flight_id", chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("time", "event_id", fix.alias("f"))), asc=False)
        .alias("_t"))
    detail = F.struct(F.struct(F.col("flight_id").alias("id"),
                               F.concat(F.lit("CS"), F.col("flight_id")).alias("callsign"))
                      .alias("identification"),
                      F.transform("_t", lambda x: x["f"]).alias("trail"))
    return g.select("chunk", F.to_json(detail).alias("payload"))


def track_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per tracked flight: destination code (user % 25) and scheduled arrival epoch."""
    e = table(spark, sf_dir, "events")
    users = e.select("user_id").distinct()
    return users.select(
        F.col("user_id").cast("string").alias("flight_id"),
        (F.col("user_id") % 25).cast("string").alias("destination_iata"),
        (F.lit(TRACK_ARRIVAL0) + (F.col("user_id") % 24) * HOUR).alias("scheduled_arrival"))


def detail_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flight-detail JSON document per order (no trail); some lack a destination."""
    o = _orders(spark, sf_dir)
    k = F.col("o_orderkey")

    def port(code: Column) -> Column:
        pos = F.when(code < 25, F.struct(
            ((code * 37) % 121 - 60).cast("double").alias("latitude"),
            ((code * 53) % 301 - 150).cast("double").alias("longitude"),
            (code * 10).cast("double").alias("altitude"),
            F.struct(F.concat(F.lit("Country "), code % 5).alias("name")).alias("country")))
        return F.struct(F.concat(F.lit("Airport "), code).alias("name"),
                        F.struct(code.cast("string").alias("iata")).alias("code"),
                        pos.alias("position"))

    detail = F.struct(
        F.struct(F.concat(F.lit("F"), k).alias("id"),
                 F.concat(F.lit("CS"), F.col("o_custkey") % 200).alias("callsign"))
        .alias("identification"),
        F.struct(F.struct(F.concat(F.lit("Model "), k % 7).alias("text"),
                          F.concat(F.lit("M"), k % 7).alias("code")).alias("model")).alias("aircraft"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("airline"),
        F.struct(port(F.col("dep_code")).alias("origin"),
                 F.when(k % 13 != 0, port(F.col("arr_code"))).alias("destination")).alias("airport"),
        F.struct(F.struct(F.col("dep_e").alias("departure"), F.col("arr_e").alias("arrival"))
                 .alias("scheduled"),
                 F.struct((F.col("dep_e") + (k % 9) * 60).alias("departure"),
                          (F.col("arr_e") + (k % 9) * 60).alias("arrival")).alias("real"),
                 F.struct((F.col("dep_e") + 60).alias("departure"),
                          (F.col("arr_e") + 120).alias("arrival")).alias("estimated"),
                 F.struct((F.col("arr_e") - F.col("dep_e")).cast("string").alias("flighttime"),
                          ((k % 9) * 60).cast("string").alias("delay")).alias("historical"))
        .alias("time"),
    )
    return o.select(F.to_json(detail).alias("payload"))


# ------------------------------------------------------------------ misc
def iso_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.ts`` as ISO text: naive, ``+00:00`` and local ``+05:30`` styles."""
    e = table(spark, sf_dir, "events")
    return e.select("event_id", _iso(_epoch("ts"), F.col("event_id") % 3).alias("iso_text"))


def snapshots_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payload snapshots: source = event type, empty payload when id % 3 = 0."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("source"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ingest_us"),
        F.col("event_id").alias("snapshot_id"),
        F.when(F.col("event_id") % 3 == 0, F.array().cast("array<string>"))
         .otherwise(F.array(F.col("props"))).alias("data"))
