"""JDBC scans: connection text per dialect, and reads split by a column."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Other names of a dialect, driver classes, URL shapes.
DIALECT_ALIASES = {"sql": "azuresql", "mssql": "azuresql", "azure_sql": "azuresql"}
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "azuresql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
    "redshift": "com.amazon.redshift.jdbc.Driver",
    "saphana": "com.sap.db.jdbc.Driver",
}
SQL_SERVER_SETTINGS = "encrypt=true;trustServerCertificate=false;loginTimeout=30;"
ORACLE_URLS = {
    "service": "jdbc:oracle:thin:@//{host}:{port}/{value}",
    "sid": "jdbc:oracle:thin:@{host}:{port}:{value}",
    "ezconnect": "jdbc:oracle:thin:@//{value}",
    "descriptor": "jdbc:oracle:thin:@{value}",
}
ORACLE_KEYS = {
    "service": ("service_name", "servicename", "service"),
    "sid": ("sid",),
    "ezconnect": ("ezconnect",),
    "descriptor": ("connect_descriptor",),
}


def connection_options(dialect: str, connection: Mapping[str, Any]) -> dict[str, str]:
    """The ``url`` and ``driver`` options of a dialect, from connection settings."""
    name = dialect.strip().lower()
    name = DIALECT_ALIASES.get(name, name)
    given = {k.lower(): v for k, v in connection.items() if v not in (None, "")}
    if name == "jdbc":
        if "url" not in given:
            raise ValueError("a generic JDBC source needs the connection setting 'url'")
        return {"url": given["url"], **({"driver": given["driver"]} if "driver" in given else {})}
    if name not in DRIVERS:
        raise ValueError(f"{dialect} is not a JDBC source; known are {', '.join(DRIVERS)}")
    url = _URLS[name](given)
    custom = name in ("redshift", "saphana")
    return {"url": url, "driver": given.get("driver", DRIVERS[name]) if custom else DRIVERS[name]}


def _sql_server(given: Mapping[str, Any]) -> str:
    address = f"jdbc:sqlserver://{given['host']}:{given['port']}"
    if "database" not in given:
        return address
    return f"{address};database={given['database']};{SQL_SERVER_SETTINGS}"


def _azure_sql(given: Mapping[str, Any]) -> str:
    if "database" not in given:
        raise ValueError("an Azure SQL connection needs 'database'")
    return _sql_server(given)


def _postgresql(given: Mapping[str, Any]) -> str:
    database = given.get("database") or given.get("dbname") or "postgres"
    return f"jdbc:postgresql://{given['host']}:{given['port']}/{database}"


def _mysql(given: Mapping[str, Any]) -> str:
    return f"jdbc:mysql://{given['host']}:{given['port']}"


def _oracle(given: Mapping[str, Any]) -> str:
    for way, keys in ORACLE_KEYS.items():
        value = next((given[k] for k in keys if k in given), None)
        if value is not None:
            return ORACLE_URLS[way].format(host=given.get("host"), port=given.get("port"), value=value)
    raise ValueError(f"an Oracle connection needs one of {[k for ks in ORACLE_KEYS.values() for k in ks]}")


def _redshift(given: Mapping[str, Any]) -> str:
    database = given.get("database") or given.get("dbname")
    address = f"jdbc:redshift://{given['host']}:{given['port']}" + (f"/{database}" if database else "")
    return _with_parameters(address, "?", given.get("jdbc_params") or {})


def _sap_hana(given: Mapping[str, Any]) -> str:
    address = given.get("url") or f"jdbc:sap://{given['host']}:{given['port']}"
    schema = {"currentSchema": given["currentschema"]} if "currentschema" in given else {}
    parameters = {**(given.get("jdbc_params") or {})}
    parameters = {**parameters, **{k: v for k, v in schema.items() if k not in parameters}}
    texts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in parameters.items()}
    return _with_parameters(address, "&" if "?" in address else "/?", texts)


def _with_parameters(address: str, separator: str, parameters: Mapping[str, Any]) -> str:
    if not parameters:
        return address
    return address + separator + "&".join(f"{k}={v}" for k, v in parameters.items())


_URLS = {
    "sqlserver": _sql_server,
    "azuresql": _azure_sql,
    "postgresql": _postgresql,
    "mysql": _mysql,
    "oracle": _oracle,
    "redshift": _redshift,
    "saphana": _sap_hana,
}


def read_options(
    dialect: str,
    connection: Mapping[str, Any],
    table: str | None = None,
    query: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """All options of one JDBC read."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    options = connection_options(dialect, connection)
    options |= {"user": connection["username"], "password": connection["password"]}
    options |= {"dbtable": table} if table is not None else {"query": query}
    return options | {"fetchsize": str(fetch_size)}


def scan_jdbc(
    spark: SparkSession,
    dialect: str,
    connection: Mapping[str, Any],
    table: str,
    split_column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A remote table, read in ranges of ``split_column`` by many tasks at once.

    The bounds are asked of the database. Spark puts NULLs and everything outside
    the bounds into the outer ranges, so no row is lost.
    """
    options = read_options(dialect, connection, table)
    if split_column and partitions > 1:
        ends = read_options(
            dialect, connection, query=f"SELECT MIN({split_column}) lo, MAX({split_column}) hi FROM {table}"
        )
        low, high = spark.read.format("jdbc").options(**ends).load().first()
        if low is not None and low != high:
            options |= split_options(split_column, low, high, partitions)
    return spark.read.format("jdbc").options(**options).load()


def split_options(column: str, low: Any, high: Any, partitions: int) -> dict[str, str]:
    """Options that split a read into ranges of a column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }
