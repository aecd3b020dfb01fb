"""How a registered query and its checking SQL agree on columns and types.

A *shape* such as ``"claim_id:s n:i rate:d flag:b"`` names the output columns. Both sides are cast
by it: ``s`` text, ``i`` 64-bit integer, ``d`` double rounded to 6 places, ``m`` sum of
money rounded to pence, ``b`` boolean, ``t``
timestamp as text, ``D`` date as text, ``a`` array of text joined with ``|``.

Means of short decimals often end exactly on a half of the last place, where the last bit of a double
decides the rounding; both sides are shifted by the same tiny amount off that edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans import inputs

_OFF_EDGE = 1.37e-8

QUERIES: dict = {}
ORACLES: dict = {}
_CHECKS: dict = {}


def _pairs(shape: str):
    return [item.rsplit(":", 1) for item in shape.split()]


def shaped(df: DataFrame, shape: str) -> DataFrame:
    casts = {
        "s": lambda c: F.col(c).cast("string"),
        "i": lambda c: F.col(c).cast("bigint"),
        "d": lambda c: F.round(F.col(c).cast("double") + F.lit(_OFF_EDGE), 6) + F.lit(0.0),
        "m": lambda c: F.round(F.col(c).cast("double"), 2) + F.lit(0.0),
        "b": lambda c: F.col(c).cast("boolean"),
        "t": lambda c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss"),
        "D": lambda c: F.date_format(F.col(c), "yyyy-MM-dd"),
        "a": lambda c: F.array_join(F.col(c), "|"),
    }
    return df.select(*[casts[kind](name).alias(name) for name, kind in _pairs(shape)])


def shaped_sql(body: str, shape: str) -> str:
    casts = {
        "s": "CAST({0} AS VARCHAR)",
        "i": "CAST({0} AS BIGINT)",
        "d": "round(CAST({0} AS DOUBLE) + %r, 6) + 0e0" % _OFF_EDGE,
        "m": "round(CAST({0} AS DOUBLE), 2) + 0e0",
        "b": "CAST({0} AS BOOLEAN)",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
        "D": "strftime({0}, '%Y-%m-%d')",
        "a": "array_to_string({0}, '|')",
    }
    columns = ", ".join(f'{casts[kind].format(name)} AS {name}' for name, kind in _pairs(shape))
    return f"SELECT {columns} FROM ({body}) AS result"


def register(key: str, shape: str | None, run, sql: str | None = None) -> None:
    """Add one query. ``run(spark, sf_dir)`` gives the frame; ``sql`` is the check, if one exists."""
    from tidemark.session import prepare

    def query(spark, sf_dir):
        prepare(spark)
        df = run(spark, sf_dir)
        return shaped(df, shape) if shape else df

    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")
    QUERIES[key] = query
    _CHECKS[key] = (shape, sql)
    if sql is not None:
        ORACLES[key] = shaped_sql(sql, shape)


def register_twin(key: str, of: str, run) -> None:
    """Add another way to the rows of a registered query, checked on the same columns by the same SQL."""
    shape, sql = _CHECKS[of]
    register(key, shape, run, sql)


def values_sql(rows) -> str:
    """Rows of a reference table as a DuckDB VALUES list."""
    def text(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        if isinstance(v, int):
            return str(v)
        return "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows) + ")"


def in_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def ts(seconds: str) -> str:
    """Epoch seconds as a DuckDB timestamp."""
    return f"make_timestamp(({seconds}) * 1000000)"


def src(name: str) -> str:
    return inputs.source_sql(name)
