"""Column expressions for JSON text: strictness, quoting, types.

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation.  Spark's JSON readers are lax (they accept
trailing text); Python's ``json.loads`` is strict, so strictness is rebuilt
from two wrapped parses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_json(c) -> Column:
    """True when ``c`` is exactly one complete JSON text, else false.

    ``[c]`` must parse to an array of exactly one element and
    ``{"v":c}`` must parse too: together they reject trailing text
    (``{"a":1} x``) and split texts (``1],[2``).  Null input is false.
    """
    c = _c(c)
    as_array = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))), "$", "array<variant>"
    )
    as_member = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.coalesce(as_member.isNotNull() & (F.size(as_array) == 1), F.lit(False))


def json_quote(c) -> Column:
    """JSON literal of a string column: ``"text"`` with escapes, or ``null``."""
    wrapped = F.to_json(F.struct(_c(c).alias("v")), {"ignoreNullFields": "false"})
    # wrapped is {"v":<literal>}; keep <literal>.
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def variant_kind(v) -> Column:
    """Coarse type of a VARIANT value: OBJECT ARRAY STRING INT FLOAT BOOLEAN NULL.

    Null input (a missing path) gives null.  Integral DECIMAL (scale 0) is INT,
    other DECIMAL and DOUBLE/FLOAT are FLOAT, as Python's ``json`` would type them.
    """
    s = F.schema_of_variant(_c(v))
    return (
        F.when(s.isNull(), F.lit(None))
        .when(s.startswith("OBJECT"), F.lit("OBJECT"))
        .when(s.startswith("ARRAY"), F.lit("ARRAY"))
        .when(s == "STRING", F.lit("STRING"))
        .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("INT"))
        .when(s.rlike(r"^DECIMAL\(\d+,0\)$"), F.lit("INT"))
        .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("FLOAT"))
        .when(s == "BOOLEAN", F.lit("BOOLEAN"))
        .when(s == "VOID", F.lit("NULL"))
        .otherwise(s)
    )


# Python type names of JSON values, as ``type(v).__name__``.
PY_TYPE_NAMES = {
    "STRING": "str",
    "INT": "int",
    "FLOAT": "float",
    "BOOLEAN": "bool",
    "NULL": "NoneType",
    "OBJECT": "dict",
    "ARRAY": "list",
}


def py_type_name(kind: Column) -> Column:
    """Map :func:`variant_kind` to the Python type name."""
    expr = F.when(F.lit(False), F.lit(None))
    for k, name in PY_TYPE_NAMES.items():
        expr = expr.when(kind == k, F.lit(name))
    return expr
