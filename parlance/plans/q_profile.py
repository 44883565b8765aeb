"""Registered queries: profiling on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators import profile as pr
from parlance.plans.oracle_sql import with_views
from parlance.plans.q_splits import stored_splits
from parlance.plans.registry import register, rounded
from parlance.sources import views
from parlance.sources.tables import table

# Columns of the driver tables the SQL side needs to spell out.
ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
PART_STRINGS = ["p_name", "p_brand", "p_type"]
DOC_STRINGS = ["text", "lang", "source"]
LINEITEM_NUMERIC = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
LABELLED_DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]

LABELLED_DOCS_SQL = (
    "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)


def labelled_docs(spark, sf_dir):
    """Documents with their labels; unlabelled documents have null labels."""
    d = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    lab = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return d.join(lab, "doc_id", "left")


_TYPE_SQL = (
    "CASE WHEN column_type = 'VARCHAR' THEN 'string' WHEN column_type = 'INTEGER' THEN 'int' "
    "WHEN column_type = 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END"
)


@register(
    "dataset_shape",
    f"SELECT CAST(row_number() OVER () AS BIGINT) AS position, column_name, {_TYPE_SQL} AS data_type, "
    f"(SELECT count(*) FROM orders) AS n_rows, CAST({len(ORDERS_COLS)} AS BIGINT) AS n_cols FROM (DESCRIBE orders)",
)
def q_dataset_shape(spark, sf_dir):
    """A1: shape, names and types of ``orders``."""
    return pr.dataset_shape(table(spark, sf_dir, "orders"))


ORDER_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@register(
    "select_columns_by_type",
    "SELECT position, column_name, category, n_present, n_distinct FROM ("
    "SELECT CAST(row_number() OVER () AS BIGINT) AS position, column_name, "
    "CASE WHEN column_type = 'VARCHAR' THEN 'string' "
    "WHEN column_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'SMALLINT', 'TINYINT', 'FLOAT', 'REAL') "
    "OR column_type LIKE 'DECIMAL%' THEN 'numeric' ELSE 'other' END AS category FROM (DESCRIBE orders)) d "
    "JOIN (" + " UNION ALL ".join(f"SELECT '{c}' AS name, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct FROM orders" for c in ORDER_COLS) + ") n "
    "ON column_name = name WHERE category <> 'other'",
)
def q_select_columns_by_type(spark, sf_dir):
    """the string and numeric columns of ``orders``, selected by type and counted (present, distinct)."""
    orders = table(spark, sf_dir, "orders")
    chosen = orders.select(*pr.string_columns(orders), *pr.numeric_columns(orders))
    present = chosen.agg(*[F.count(c).alias(c) for c in chosen.columns])
    present = present.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_present")) for c in chosen.columns])).alias("c")).select("c.*")
    return pr.select_columns_by_type(orders).join(present, "column_name").join(pr.distinct_counts(chosen), "column_name")




@register(
    "null_counts",
    with_views(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM ld"
            for c in LABELLED_DOC_COLS
        )
        + ") x WHERE n_null > 0",
        extra={"ld": LABELLED_DOCS_SQL},
    ),
)
def q_null_counts(spark, sf_dir):
    """A2: missing values per column of documents left-joined with labels."""
    return pr.null_counts(labelled_docs(spark, sf_dir))


@register(
    "drop_null_text",
    with_views("SELECT doc_id, quality FROM ld WHERE quality IS NOT NULL", extra={"ld": LABELLED_DOCS_SQL}),
)
def q_drop_null_text(spark, sf_dir):
    """rows whose label is present."""
    return pr.drop_null_text(labelled_docs(spark, sf_dir), "quality").select("doc_id", "quality")


@register(
    "distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM customer" for c in CUSTOMER_COLS
    ),
)
def q_distinct_counts(spark, sf_dir):
    """A3: distinct values per column of ``customer``."""
    return pr.distinct_counts(table(spark, sf_dir, "customer"))


@register(
    "value_counts",
    with_views("SELECT intent, count(*) AS n FROM utterances WHERE intent IS NOT NULL GROUP BY intent", "utterances"),
)
def q_value_counts(spark, sf_dir):
    """A4: rows per intent."""
    return pr.value_counts(views.utterances(spark, sf_dir), "intent")


_PART_LONG = " UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM part" for c in PART_STRINGS)


@register(
    "categorical_profile",
    f"""
WITH counts AS (SELECT column_name, value, count(*) AS n FROM ({_PART_LONG}) l WHERE value IS NOT NULL
                GROUP BY column_name, value),
     per AS (SELECT column_name, count(*) AS n_distinct FROM counts GROUP BY column_name HAVING count(*) < 100)
SELECT column_name, n_distinct, value, n, rank FROM (
  SELECT c.column_name, p.n_distinct, c.value, c.n,
         CAST(row_number() OVER (PARTITION BY c.column_name ORDER BY c.n DESC, c.value) AS BIGINT) AS rank
  FROM counts c JOIN per p USING (column_name)) x
WHERE rank <= 10
""",
)
def q_categorical_profile(spark, sf_dir):
    """A5 + K2: low-cardinality string columns of ``part`` with their top values."""
    return pr.categorical_profile(table(spark, sf_dir, "part"))


@register(
    "top_values",
    f"""
WITH counts AS (SELECT column_name, value, count(*) AS n FROM ({_PART_LONG}) l WHERE value IS NOT NULL
                GROUP BY column_name, value),
     per AS (SELECT column_name, count(*) AS n_distinct FROM counts GROUP BY column_name HAVING count(*) < 100)
SELECT column_name, value, n FROM (
  SELECT c.column_name, c.value, c.n,
         row_number() OVER (PARTITION BY c.column_name ORDER BY c.n DESC, c.value) AS rank
  FROM counts c JOIN per p USING (column_name)) x
WHERE rank <= 10
""",
)
def q_top_values(spark, sf_dir):
    """K2: ten most frequent values of each categorical column of ``part``."""
    return pr.categorical_profile(table(spark, sf_dir, "part")).select("column_name", "value", "n")


_DOC_AVG = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CAST(length({c}) AS DOUBLE)) AS avg_length FROM documents"
    for c in DOC_STRINGS
)


@register("text_column_profile", f"SELECT column_name, round(avg_length, 6) AS avg_length FROM ({_DOC_AVG}) x WHERE avg_length > 10")
def q_text_column_profile(spark, sf_dir):
    """Text columns (mean length > 10) of ``documents``."""
    return rounded(pr.text_column_profile(table(spark, sf_dir, "documents", "doc_id", *DOC_STRINGS)))


@register(
    "text_samples",
    f"""
SELECT column_name, rank, "left"(value, 100) AS preview FROM (
  SELECT column_name, value, CAST(row_number() OVER (PARTITION BY column_name ORDER BY doc_id) AS BIGINT) AS rank
  FROM ({" UNION ALL ".join(f"SELECT doc_id, '{c}' AS column_name, {c} AS value FROM documents" for c in DOC_STRINGS)}) l
  WHERE value IS NOT NULL AND column_name IN (SELECT column_name FROM ({_DOC_AVG}) a WHERE avg_length > 10)) x
WHERE rank <= 3
""",
)
def q_text_samples(spark, sf_dir):
    """K8 + P18: first three texts of each text column, 100 characters."""
    return pr.text_samples(table(spark, sf_dir, "documents", "doc_id", *DOC_STRINGS), "doc_id")


@register("text_preview", 'SELECT doc_id, "left"(text, 100) AS preview FROM documents')
def q_text_preview(spark, sf_dir):
    """First 100 characters of every document."""
    d = table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", pr.text_preview("text", 100).alias("preview"))


@register(
    "head_rows",
    with_views("SELECT * FROM utterances ORDER BY row_id LIMIT 5", "utterances"),
)
def q_head_rows(spark, sf_dir):
    """K1: first five utterances."""
    return pr.head_rows(views.utterances(spark, sf_dir), 5)


@register(
    "head_pairs",
    with_views("SELECT row_id, input_text, output_text FROM splits WHERE split = 'train' ORDER BY row_id LIMIT 3", "splits"),
)
def q_head_pairs(spark, sf_dir):
    """K1: the three example pairs of the train split."""
    train = stored_splits(spark, sf_dir).where("split = 'train'")
    return pr.head_rows(train.select("row_id", "input_text", "output_text"), 3)


def _describe_sql(col: str) -> str:
    v = f"CAST({col} AS DOUBLE)"
    return (
        f"SELECT '{col}' AS column_name, count({col}) AS count, round(avg({v}), 6) AS mean, "
        f"round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min, "
        f"round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50, "
        f"round(quantile_cont({v}, 0.75), 6) AS p75, round(max({v}), 6) AS max FROM lineitem"
    )


@register("numeric_describe", " UNION ALL ".join(_describe_sql(c) for c in LINEITEM_NUMERIC))
def q_numeric_describe(spark, sf_dir):
    """describe() of the numeric columns of ``lineitem`` with exact quartiles."""
    return rounded(pr.numeric_describe(table(spark, sf_dir, "lineitem", *LINEITEM_NUMERIC)))
