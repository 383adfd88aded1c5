"""Tables in a database, by JDBC, and their creation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.operators.tables import keep_one
from masterline.plans.schemas import KEYS, NOT_NULL, TABLES

#: What becomes of a column of a known key: the new value; the first of new and old that isn't null; of old and new;
#: the old value.
POLICIES = ("replace", "new_first", "old_first", "keep")

#: Types of TABLES in standard SQL; arrays and maps are text there.
SQL_TYPES = {"string": "VARCHAR(8000)", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE PRECISION", "date": "DATE", "timestamp": "TIMESTAMP"}


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) of each column of a logical table."""
    parts = TABLES[table].replace("decimal(18,4)", "decimal(18#4)").replace("map<string,string>", "map<string#string>").split(", ")
    return [(n, k.replace("#", ",")) for n, k in (x.split(" ", 1) for x in parts)]


def quoted_name(name: str) -> str:
    """An identifier in double quotes, whatever it holds."""
    return '"' + name.replace('"', '""') + '"'


def create_statement(table: str, schema: str | None = None) -> str:
    """CREATE TABLE with the key and the not-null columns; in a schema of its own, a client's for one."""
    name = ".".join(map(quoted_name, [*([schema] if schema else []), table]))
    must = {*KEYS.get(table, []), *NOT_NULL.get(table, [])}
    kind = lambda k: "DECIMAL(18,4)" if k.startswith("decimal") else SQL_TYPES.get(k, "VARCHAR(32000)")
    lines = [f"{quoted_name(n)} {kind(k)}{' NOT NULL' if n in must else ''}" for n, k in columns(table)]
    key = [f"PRIMARY KEY ({', '.join(map(quoted_name, KEYS[table]))})"] if table in KEYS else []
    return f"CREATE TABLE {name} ({', '.join(lines + key)})"


def create_tables(spark: SparkSession, database: str) -> list[str]:
    """The logical tables as empty Parquet tables of a catalog database, where they don't exist yet; their names."""
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE `{database}`")
    made = []
    for table in TABLES:
        if not spark.catalog.tableExists(f"{database}.{table}"):
            spark.sql(f"CREATE TABLE `{database}`.`{table}` ({TABLES[table]}) USING parquet")
            made.append(table)
    return made


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None, key: str | None = None, parts: int = 16) -> DataFrame:
    """A database table. With a numeric key it is read in `parts` ranges of that key, each by a task of its own."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if key:
        low, high = spark.read.format("jdbc").options(url=url, query=f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}", **(properties or {})).load().first()
        if low is not None:
            reader = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(int(high) + 1), numPartitions=str(parts))
    return reader.load()


def write_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, mode: str = "append") -> None:
    """Rows into a database table: appended, or in place of its rows (the table itself stays)."""
    df.write.format("jdbc").options(url=url, dbtable=table, truncate="true", **(properties or {})).mode(mode).save()


def qualified(table: str) -> str:
    """A table name, with its schema before a dot if it has one, in double quotes."""
    return ".".join(map(quoted_name, table.split(".")))


def index_statement(table: str, columns_: Iterable[str], unique: bool = False) -> str:
    """CREATE INDEX over columns of a table: for lookups by name, for one."""
    columns_ = list(columns_)
    name = quoted_name("_".join(["idx", table.replace(".", "_"), *columns_]))
    return f"CREATE {'UNIQUE ' if unique else ''}INDEX {name} ON {qualified(table)} ({', '.join(map(quoted_name, columns_))})"


def conflict_statement(table: str, stage: str, columns_: list[str], keys: list[str], policy: str = "replace") -> str:
    """One INSERT ... ON CONFLICT that takes the rows of a staging table into a table whose unique key is keys."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    own, rest = qualified(table), [c for c in columns_ if c not in keys]
    old = quoted_name(table.split(".")[-1])
    value = {"replace": "excluded.{c}", "new_first": "COALESCE(excluded.{c}, {t}.{c})", "old_first": "COALESCE({t}.{c}, excluded.{c})"}.get(policy)
    sets = ", ".join(f"{quoted_name(c)} = {value.format(c=quoted_name(c), t=old)}" for c in rest) if value and rest else ""
    names = ", ".join(map(quoted_name, columns_))
    return f"INSERT INTO {own} ({names}) SELECT DISTINCT {names} FROM {qualified(stage)} WHERE 1 = 1 ON CONFLICT ({', '.join(map(quoted_name, keys))}) DO {f'UPDATE SET {sets}' if sets else 'NOTHING'}"


def merge_statements(table: str, stage: str, once: str, columns_: list[str], keys: list[str], policy: str = "replace", marked: Iterable[str] = ()) -> list[str]:
    """The same by standard MERGE, for databases without ON CONFLICT: different rows first go to the empty table once.

    marked: columns of the staging table in which text has "=" before it and null is empty, see stage_rows.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    q, rest = quoted_name, [c for c in columns_ if c not in keys]
    value = {"replace": "s.{c}", "new_first": "COALESCE(s.{c}, t.{c})", "old_first": "COALESCE(t.{c}, s.{c})"}.get(policy)
    update = f" WHEN MATCHED THEN UPDATE SET {', '.join(f'{q(c)} = {value.format(c=q(c))}' for c in rest)}" if value and rest else ""
    on = " AND ".join(f"t.{q(k)} = s.{q(k)}" for k in keys)
    names = ", ".join(map(q, columns_))
    given = lambda c: f"CASE WHEN {q(c)} = '' THEN CAST(NULL AS VARCHAR(8000)) ELSE SUBSTR({q(c)}, 2) END" if c in marked else q(c)
    return [
        f"INSERT INTO {qualified(once)} ({names}) SELECT DISTINCT {', '.join(map(given, columns_))} FROM {qualified(stage)}",
        f"MERGE INTO {qualified(table)} t USING {qualified(once)} s ON {on}{update} WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({', '.join(f's.{q(c)}' for c in columns_)})",
    ]


def execute(spark: SparkSession, url: str, statements: Iterable[str], properties: Mapping[str, str] | None = None) -> None:
    """Run statements in one transaction, on a connection of the driver's JVM."""
    own = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        own.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, own)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.dataType.simpleString() == "string"]


def stage_rows(df: DataFrame, url: str, stage: str, properties: Mapping[str, str] | None = None, mode: str = "overwrite", marked: bool = False) -> None:
    """Rows into a staging table without keys, text as VARCHAR, so that it can be compared; each task commits for itself.

    marked: text gets "=" before it and null becomes empty, for drivers that can't be given null text.
    """
    texts = text_columns(df)
    if marked:
        df = df.withColumns({c: F.when(F.col(c).isNull(), "").otherwise(F.concat(F.lit("="), F.col(c))) for c in texts})
    kinds = ", ".join(f"`{c}` VARCHAR(8000)" for c in texts)
    df.write.format("jdbc").options(url=url, dbtable=qualified(stage), **({"createTableColumnTypes": kinds} if texts else {}), **(properties or {})).mode(mode).save()


def upsert_table(df: DataFrame, url: str, table: str, keys: list[str], policy: str = "replace", order: str | None = None, properties: Mapping[str, str] | None = None, on_conflict: bool = True) -> None:
    """Rows of df into a database table with a unique key, all or none of them.

    policy: one of POLICIES, for keys that the table has already; other keys come in. Of several rows of a key the last
    by `order` (a column that isn't written) counts, or some one without it; rows with a null in the key are left out.
    Tasks write to the table {table}_stage, each in a transaction of its own, and a new run empties it; a task that had
    committed and was run again leaves its rows there twice. So that table has no key, and its different rows go on by
    one set-based statement, in one transaction: a run that ends early, or is repeated, changes nothing that a whole one
    would not. Without on_conflict, it is MERGE over a second table, {table}_once.
    """
    stage, once = f"{table}_stage", f"{table}_once"
    one = keep_one(df.dropna(subset=keys), keys, F.col(order) if order else F.lit(0), last=True)
    one = one.drop(order) if order and order not in keys else one
    stage_rows(one, url, stage, properties, marked=not on_conflict)
    if on_conflict:
        statements = [conflict_statement(table, stage, one.columns, keys, policy)]
    else:
        stage_rows(one.limit(0), url, once, properties)
        statements = merge_statements(table, stage, once, one.columns, keys, policy, text_columns(one))
    execute(df.sparkSession, url, statements, properties)
