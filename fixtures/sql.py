"""The fixture views and the split as SQL text, for checking against another engine."""

from __future__ import annotations

from pricewright.functions.numeric import (
    BAG_DRAWS, FOLD_STREAM, MODULUS, SIZE_STREAM, TEST_STREAM, bag_limits, bag_stream, seed_offset)
from pricewright.sources.tables import NULL_TOKENS
from pricewright.spec import AIRFARES as SPEC


def bucket(key: str, buckets: int, stream: int, seed: int = SPEC.seed) -> str:
    return f"CAST((((({key}) % {MODULUS}) * {stream} + {seed_offset(seed)}) % {MODULUS}) * {buckets} // {MODULUS} AS INTEGER)"


def bag_weight(key: str, tree: int, seed: int = SPEC.seed) -> str:
    """How often a row is in the bootstrap sample of a tree."""
    draw = bucket(key, BAG_DRAWS, bag_stream(tree), seed)
    return "(" + " + ".join(f"CAST({draw} >= {limit} AS DOUBLE)" for limit in bag_limits()) + ")"


IS_TEST = f"({bucket('rid', 10_000, TEST_STREAM)} < 2000)"
FOLD = bucket("rid", 5, FOLD_STREAM)
SIZE = bucket("rid", 1000, SIZE_STREAM)

COLUMNS = ("Airline", "Source", "Source_Name", "Destination", "Destination_Name", "Date", "Arrival_Date",
           "Duration_hrs", "Stop_Raw", "Aircraft_Type", "Class", "Booking_Source", "Base_Fare",
           "Tax_Surcharge", "Total_Fare", "Season", "Days_Before_Departure")
_NUMBERS = ("Duration_hrs", "Base_Fare", "Tax_Surcharge", "Total_Fare", "Days_Before_Departure")

_FARES = """
  SELECT *, Base_Fare + Tax_Surcharge AS Total_Fare FROM (
    SELECT *, Base_Fare * l_tax AS Tax_Surcharge FROM (
      SELECT *, (20000.0 + l_extendedprice * 0.25)
                * CASE Class WHEN 'First Class' THEN 3.0 WHEN 'Business' THEN 2.0 ELSE 1.0 END
                * (1.0 + Duration_hrs * 0.05) AS Base_Fare FROM (
        SELECT l_orderkey * 1000003 + l_partkey * 101 + l_suppkey * 7 + l_linenumber AS rid,
          p_brand AS Airline, cn.n_name AS Source, 'City ' || cn.n_name AS Source_Name,
          sn.n_name AS Destination, 'City ' || sn.n_name AS Destination_Name,
          l_shipdate AS Date, strftime(l_shipdate, '%Y-%m-%d') AS Arrival_Date,
          l_quantity * 0.3 + 0.2 AS Duration_hrs,
          CASE l_returnflag WHEN 'N' THEN 'Direct' WHEN 'A' THEN '1 Stop' WHEN 'R' THEN '2 Stops' END AS Stop_Raw,
          p_type AS Aircraft_Type,
          CASE c_mktsegment WHEN 'FURNITURE' THEN 'First Class' WHEN 'BUILDING' THEN 'Business'
               ELSE 'Economy' END AS Class,
          CASE o_orderstatus WHEN 'F' THEN 'Online Website' WHEN 'O' THEN 'Travel Agency'
               WHEN 'P' THEN 'Direct Booking' END AS Booking_Source,
          CASE o_orderpriority WHEN '1-URGENT' THEN 'Eid' WHEN '2-HIGH' THEN 'Hajj'
               WHEN '3-MEDIUM' THEN 'Winter Holidays' ELSE 'Regular' END AS Season,
          CAST(((date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) % 90) + 90) % 90 + 1
               AS BIGINT) AS Days_Before_Departure,
          l_extendedprice, l_tax
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
          JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
          JOIN part ON l_partkey = p_partkey)))"""

_DIRTY = """
  SELECT CASE WHEN rid % 89 = 1 THEN NULL ELSE Airline END AS Airline, Source,
    CASE WHEN rid % 53 = 9 THEN NULL ELSE Source_Name END AS Source_Name, Destination, Destination_Name,
    CASE WHEN rid % 79 = 3 THEN 'bad' ELSE strftime(Date, '%Y-%m-%d') END AS Date, Arrival_Date,
    CASE WHEN rid % 73 = 4 THEN 'x' ELSE CAST(Duration_hrs AS VARCHAR) END AS Duration_hrs,
    CASE WHEN rid % 61 = 7 THEN '3 Stops' WHEN rid % 59 = 8 THEN ' direct ' ELSE Stop_Raw END AS Stop_Raw,
    CASE WHEN rid % 83 = 2 THEN NULL ELSE Aircraft_Type END AS Aircraft_Type, Class, Booking_Source,
    CASE WHEN rid % 71 = 5 THEN '100' WHEN rid % 67 = 6 THEN '900000'
         ELSE CAST(Base_Fare AS VARCHAR) END AS Base_Fare,
    CASE WHEN rid % 97 = 0 THEN NULL
         WHEN rid % 47 = 10 THEN ['NA', 'N/A', 'null', '', 'NaN'][(rid // 10) % 5 + 1]
         ELSE CAST(Tax_Surcharge AS VARCHAR) END AS Tax_Surcharge,
    CASE WHEN rid % 41 = 12 THEN CAST(Total_Fare + 1000 AS VARCHAR)
         ELSE CAST(Total_Fare AS VARCHAR) END AS Total_Fare, Season,
    CAST(Days_Before_Departure AS VARCHAR) AS Days_Before_Departure
  FROM (SELECT * FROM fares UNION ALL SELECT * FROM fares WHERE rid % 43 = 11)"""


def _typed() -> str:
    tokens = ", ".join(f"'{t}'" for t in NULL_TOKENS)
    present = {c: f"CASE WHEN {c} NOT IN ({tokens}) THEN {c} END" for c in COLUMNS}
    typed = {c: f"TRY_CAST({present[c]} AS DOUBLE)" for c in _NUMBERS}
    typed["Date"] = f"TRY_CAST({present['Date']} AS TIMESTAMP)"
    return "SELECT " + ", ".join(f"{typed.get(c, present[c])} AS {c}" for c in COLUMNS) + " FROM dirty"


def _in_range() -> str:
    tests = " AND ".join(f"({c} IS NULL OR ({c} >= {lo} AND {c} <= {hi}))"
                         for c, (lo, hi) in SPEC.bounds.items())
    return f"SELECT * FROM typed WHERE {tests}"


def mode_of(column: str, source: str) -> str:
    return (f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} "
            f"ORDER BY count(*) DESC, {column} LIMIT 1)")


def filled_columns(source: str) -> dict[str, str]:
    """Fill expression per column for the configured strategies, statistics over ``source``."""
    out = {c: c for c in COLUMNS}
    for c, strategy in SPEC.imputation.items():
        if strategy == "median":
            out[c] = f"coalesce({c}, (SELECT median({c}) FROM {source}))"
        elif strategy == "mode":
            out[c] = f"coalesce({c}, {mode_of(c, source)})"
        else:
            out[c] = f"coalesce({c}, '{strategy}')"
    return out


def _imputed() -> str:
    filled = ", ".join(f"{e} AS {c}" for c, e in filled_columns("uniq").items())
    dated = f"SELECT {filled} FROM uniq WHERE Date IS NOT NULL"
    rest = {c: f"coalesce({c}, {mode_of(c, 'dated')})"
            for c in ("Source_Name", "Destination_Name", "Arrival_Date")}
    rest["Total_Fare"] = "Base_Fare + Tax_Surcharge"
    rest["Days_Before_Departure"] = "CAST(trunc(Days_Before_Departure) AS BIGINT)"
    chosen = ", ".join(f"{rest.get(c, c)} AS {c}" for c in COLUMNS)
    return f"WITH dated AS ({dated}) SELECT {chosen} FROM dated"


_FEATURES = """
  SELECT *, CAST(month(Date) AS INTEGER) AS Month, CAST(isodow(Date) - 1 AS INTEGER) AS Weekday,
    CASE WHEN lower(trim(Stop_Raw)) = 'direct' THEN 'Non_Stop' ELSE 'With_Stop' END AS Stop_Type,
    Source || '→' || Destination AS Route, {extra} FROM {source}"""

_NORMAL = """SELECT * REPLACE (CASE Class WHEN 'First Class' THEN 'First' ELSE Class END AS Class)
  FROM in_range"""

# every view names the views it needs
_VIEWS = {
    "fares": ((), _FARES),
    "dirty": (("fares",), _DIRTY),
    "typed": (("dirty",), _typed()),
    "in_range": (("typed",), _in_range()),
    "uniq": (("in_range",), f"SELECT DISTINCT * FROM ({_NORMAL})"),
    "clean": (("uniq",), f"SELECT * FROM ({_imputed()}) WHERE Base_Fare >= 500"),
    "clean_features": (("clean",), _FEATURES.format(extra="1 AS one", source="clean")),
    "features": (("fares",), _FEATURES.format(
        extra=f"{IS_TEST} AS is_test, {FOLD} AS fold, {SIZE} AS size_rank, ln(1 + Total_Fare) AS label",
        source="fares")),
}


def query(view: str, body: str) -> str:
    """``body`` over the named view, with everything the view needs in front."""
    needed: list[str] = []

    def need(name: str) -> None:
        for parent in _VIEWS[name][0]:
            need(parent)
        if name not in needed:
            needed.append(name)

    for name in view.split():
        need(name)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name][1]})" for name in needed)
    return f"WITH {ctes}\n{body}"


def r(expression: str, digits: int = 4) -> str:
    """Rounded, without negative zero."""
    return f"(round({expression}, {digits}) + 0.0)"
