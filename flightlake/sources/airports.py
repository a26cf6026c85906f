"""Airport dimension (S2) and the busy-airport allow list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.schemas import AIRPORTS_CSV, AIRPORTS_DROPPED, BUSY_AIRPORTS

CSV_OPTIONS = {"header": "false", "sep": ",", "nullValue": "\\N", "quote": '"', "escape": "\\"}

# The 50 busiest airports offered in the airport picker (name, IATA).
BUSY_AIRPORT_LIST = [
    ("Hartsfield-Jackson Atlanta International", "ATL"),
    ("Dallas/Fort Worth International", "DFW"),
    ("Denver International", "DEN"),
    ("O'Hare International", "ORD"),
    ("Dubai International", "DXB"),
    ("Los Angeles International", "LAX"),
    ("Istanbul", "IST"),
    ("London Heathrow", "LHR"),
    ("Indira Gandhi International", "DEL"),
    ("Charles de Gaulle", "CDG"),
    ("John F. Kennedy International", "JFK"),
    ("McCarran International", "LAS"),
    ("Amsterdam Schiphol", "AMS"),
    ("Miami International", "MIA"),
    ("Adolfo Suárez Madrid–Barajas", "MAD"),
    ("Haneda", "HND"),
    ("Orlando International", "MCO"),
    ("Frankfurt", "FRA"),
    ("Charlotte Douglas International", "CLT"),
    ("Benito Juárez International", "MEX"),
    ("Seattle-Tacoma International", "SEA"),
    ("Phoenix Sky Harbor International", "PHX"),
    ("Newark Liberty International", "EWR"),
    ("San Francisco International", "SFO"),
    ("Barcelona–El Prat", "BCN"),
    ("George Bush Intercontinental", "IAH"),
    ("Soekarno–Hatta International", "CGK"),
    ("Chhatrapati Shivaji Maharaj International", "BOM"),
    ("Toronto Pearson International", "YYZ"),
    ("Logan International", "BOS"),
    ("Hamad International", "DOH"),
    ("El Dorado International", "BOG"),
    ("São Paulo/Guarulhos–Governador André Franco Montoro International", "GRU"),
    ("Tan Son Nhat International", "SGN"),
    ("Gatwick", "LGW"),
    ("Singapore Changi", "SIN"),
    ("Fort Lauderdale–Hollywood International", "FLL"),
    ("King Abdulaziz International", "JED"),
    ("Munich", "MUC"),
    ("Antalya", "AYT"),
    ("Sabiha Gökçen International", "SAW"),
    ("Minneapolis–Saint Paul International", "MSP"),
    ("Cancún International", "CUN"),
    ("Ninoy Aquino International", "MNL"),
    ("Jeju International", "CJU"),
    ("Leonardo da Vinci–Fiumicino", "FCO"),
    ("Paris Orly", "ORY"),
    ("Sydney Kingsford Smith", "SYD"),
    ("LaGuardia", "LGA"),
    ("Suvarnabhumi", "BKK"),
]


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """Headerless airport CSV with an explicit schema; ``type``/``source`` dropped."""
    return (spark.read.schema(AIRPORTS_CSV).options(**CSV_OPTIONS).csv(path)
            .drop(*AIRPORTS_DROPPED))


def parse_airport_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Same parse as ``read_airports`` for CSV lines held in a string column."""
    parsed = F.from_csv(F.col(line_col), AIRPORTS_CSV.simpleString(), CSV_OPTIONS)
    return df.select(parsed.alias("_a")).select("_a.*").drop(*AIRPORTS_DROPPED)


def busy_airports(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The allow list: from a ``name,iata`` CSV when given, else the fixed list."""
    if path:
        return spark.read.schema(BUSY_AIRPORTS).option("header", "true").csv(path)
    return spark.createDataFrame(BUSY_AIRPORT_LIST, BUSY_AIRPORTS)
