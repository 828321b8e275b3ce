"""JDBC sources and the connection presets they share with the JDBC sink."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

# Driver class and default port per platform.
DRIVERS = {
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "mysql": "com.mysql.jdbc.Driver",
    "oracle": "oracle.jdbc.driver.OracleDriver",
    "postgres": "org.postgresql.Driver",
    "teradata": "com.teradata.jdbc.TeraDriver",
}
DOMAIN_LOGIN_DRIVER = "net.sourceforge.jtds.jdbc.Driver"
PORTS = {"mssql": 1433, "mysql": 3306, "oracle": 1521, "postgres": 5432, "teradata": 1025}
FETCH_SIZE = "72000"


def is_true(value: object) -> bool:
    return str(value).lower() == "true"


def connection(endpoint: Mapping[str, object]) -> dict[str, str]:
    """url, driver, user and password of an endpoint; an explicit `url` wins over server and database."""
    platform = endpoint["platform"]
    windows = is_true(endpoint.get("iswindowsauthenticated", endpoint.get("isWindowsAuthenticated", False)))
    url = endpoint.get("url")
    if not url:
        if not endpoint.get("server") or not endpoint.get("database"):
            raise ValueError(f"{platform}: give url, or server and database")
        address = f"{endpoint['server']}:{endpoint.get('port') or PORTS[platform]}"
        database = endpoint["database"]
        if platform == "mssql" and windows:
            url = f"jdbc:jtds:sqlserver://{address}/{database};domain={endpoint.get('domain')};useNTLMv2=true"
        elif platform == "mssql":
            url = f"jdbc:sqlserver://{address};database={database}"
        elif platform == "oracle":
            url = f"jdbc:oracle:thin:@//{address}/{database}"
        elif platform == "mysql":
            url = f"jdbc:mysql://{address}/{database}?rewriteBatchedStatements=true&cachePrepStmts=true"
        elif platform == "postgres":
            url = f"jdbc:postgresql://{address}/{database}"
            if is_true(endpoint.get("sslenabled", False)):
                url += "?sslmode=require"
        else:
            url = _teradata_url(endpoint, windows)
    driver = DOMAIN_LOGIN_DRIVER if platform == "mssql" and windows else DRIVERS[platform]
    found = {"url": str(url), "driver": str(endpoint.get("driver", driver))}
    for option, key in (("user", "login"), ("password", "password")):
        if endpoint.get(key):
            found[option] = str(endpoint[key])
    return found


def _teradata_url(endpoint: Mapping[str, object], windows: bool) -> str:
    settings = ["LOGMECH=LDAP"] if windows else []
    settings += [
        f"TYPE={endpoint.get('typeforteradata', 'DEFAULT')}",
        f"DATABASE={endpoint['database']}",
        "TMODE=TERA",
        f"DBS_PORT={endpoint.get('port') or PORTS['teradata']}",
    ]
    level = (endpoint.get("jdbcoptions") or {}).get("logging_level")
    if level:
        settings.append(f"LOG={level}")
    return f"jdbc:teradata://{endpoint['server']}/" + ",".join(settings)


def jdbc_read_options(endpoint: Mapping[str, object], query: str | None = None) -> dict[str, str]:
    """Options of one scan: the whole table, a subquery, or a table cut into ranges of a numeric key."""
    options = {"fetchsize": FETCH_SIZE}
    options.update({k: str(v) for k, v in (endpoint.get("jdbcoptions") or {}).items()})
    options.update(connection(endpoint))
    options["dbtable"] = f"({query}) S" if query else str(endpoint["table"])
    if endpoint.get("primarykey") and not finds_ranges(endpoint):
        missing = [k for k in ("lowerBound", "upperBound", "numPartitions") if not str(endpoint.get(k, ""))]
        if missing:
            raise ValueError(f"a scan by primarykey also needs {', '.join(missing)}, or numPartitions alone")
        options["partitionColumn"] = str(endpoint["primarykey"])
        options.update({k: str(endpoint[k]) for k in ("lowerBound", "upperBound", "numPartitions")})
    return options


def finds_ranges(endpoint: Mapping[str, object]) -> bool:
    """Whether ranges of a key are asked for whose bounds are not given: the database is asked for them."""
    given = [str(endpoint.get(k, "")) for k in ("lowerBound", "upperBound")]
    return bool(endpoint.get("primarykey")) and bool(str(endpoint.get("numPartitions", ""))) and not any(given)


def bounds_query(table: str, key: str, ranges: int, platform: str) -> str:
    """SQL for the least key of each of `ranges` ranges that hold as many rows each; null keys are in none."""
    # Fixed value: the one database without NTILE has a function of its own, which counts from zero.
    tile = f"QUANTILE({ranges}, {key})" if platform == "teradata" else f"NTILE({ranges}) OVER (ORDER BY {key})"
    tiles = f"SELECT {key} AS k, {tile} AS tile FROM {table} WHERE {key} IS NOT NULL"
    return f"SELECT MIN(k) AS low FROM ({tiles}) T GROUP BY tile"


def sql_literal(value: object) -> str:
    """A key value as all databases read it."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"{value!r} cannot bound a range")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    escaped = str(value).replace("'", "''")
    return f"'{escaped}'"


def range_predicates(key: str, lows: Sequence[object]) -> list[str]:
    """Conditions that cut a table at the given keys, each row in one: the first takes smaller keys and null too."""
    cuts = [sql_literal(low) for low in sorted(set(lows))[1:]]
    if not cuts:
        return ["1 = 1"]
    middle = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{key} < {cuts[0]} OR {key} IS NULL", *middle, f"{key} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, endpoint: Mapping[str, object], query: str | None = None) -> DataFrame:
    """A table or subquery. With `primarykey` and `numPartitions` alone it is read in ranges of equal numbers of rows."""
    options = jdbc_read_options(endpoint, query)
    read = lambda more: spark.read.format(endpoint.get("format", "jdbc")).options(**{**options, **more}).load()
    if not finds_ranges(endpoint):
        return read({})
    key, ranges = str(endpoint["primarykey"]), int(endpoint["numPartitions"])
    asked = bounds_query(options["dbtable"], key, ranges, str(endpoint["platform"]))
    # at most as many rows as ranges
    lows = [row[0] for row in read({"dbtable": f"({asked}) B"}).collect()]
    predicates = range_predicates(key, lows)
    if endpoint.get("format", "jdbc") != "jdbc":
        parts = [read({"dbtable": f"(SELECT * FROM {options['dbtable']} WHERE {p}) S"}) for p in predicates]
        return reduce(DataFrame.unionByName, parts)
    rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=rest)
