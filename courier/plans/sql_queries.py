"""Registered queries over the SQL side."""

from __future__ import annotations

from pyspark.sql import functions as F

from courier.functions import sql as S
from courier.functions.packets import utc_wall_clock
from courier.plans.inputs import table
from courier.plans.registry import query


@query(
    "positional_parameters",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_totalprice > 200000.0""",
)
def positional_parameters(spark, sf_dir):
    return S.run(
        spark,
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_orderstatus = ? AND o_totalprice > ?",
        ["F", 200000.0, "never read"],
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    "named_parameters",
    """SELECT c_mktsegment, count(*) AS customers FROM customer
       WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING' GROUP BY 1""",
)
def named_parameters(spark, sf_dir):
    return S.run(
        spark,
        """SELECT c_mktsegment, count(*) AS customers FROM {customer}
           WHERE c_acctbal >= :low AND c_mktsegment <> :segment GROUP BY 1""",
        {"low": False, "segment": "BUILDING", "surplus": 1},
        customer=table(spark, sf_dir, "customer"),
    )


@query(
    "typed_reads",
    r"""SELECT doc_id,
        coalesce(TRY_CAST(nullif(regexp_extract(ltrim(text), '^([+-]?[0-9]+)', 1), '') AS BIGINT), 0)
          AS as_long, n_chars AS sized,
        CAST(trunc(quality * 1.7) AS BIGINT) AS cut, quality <> 0 AS as_bool,
        CAST(quality AS VARCHAR) AS as_text, CAST(strlen(text) AS BIGINT) AS as_bytes
        FROM documents JOIN labels USING (doc_id)""",
)
def typed_reads(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.select(
        "doc_id",
        S.read_long(F.col("text")).alias("as_long"),
        S.read_long(F.concat_ws(" ", "n_chars", "text")).alias("sized"),
        S.read_long(F.col("quality") * F.lit(1.7), "double").alias("cut"),
        S.read_bool(F.col("quality"), "bigint").alias("as_bool"),
        S.read_text(F.col("quality")).alias("as_text"),
        F.octet_length(S.read_bytes(F.col("text"))).cast("bigint").alias("as_bytes"),
    )


@query(
    "numeric_text",
    """SELECT event_id, CAST(k AS BIGINT) AS as_long, CAST(k AS INTEGER) AS as_int,
       CAST(k || '.5' AS DOUBLE) AS as_double FROM (
       SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)""",
)
def numeric_text(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.read_long(F.concat(F.lit(" "), k, F.lit("xyz"))).alias("as_long"),
        S.read_int(F.concat(k, F.lit(".9"))).alias("as_int"),
        S.read_double(F.concat(k, F.lit(".5e0 units"))).alias("as_double"),
    )


@query(
    "date_formats",
    """SELECT event_id, epoch_us(ts) / 1000000.0::DOUBLE AS seconds,
       strftime(ts, '%d.%m.%Y %H:%M:%S') AS text, epoch_us(ts) AS micros,
       epoch_us(date_trunc('second', ts)) AS text_micros FROM events""",
)
def date_formats(spark, sf_dir):
    ts, style = utc_wall_clock(F.col("ts")), "dd.MM.yyyy HH:mm:ss"
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            S.store_date(ts).alias("seconds"),
            S.store_date(ts, style).alias("text"),
            F.unix_micros(ts).alias("micros"),
        )
        .withColumn("text_micros", F.unix_micros(S.read_date(F.col("text"), style)))
    )


@query(
    "sql_functions",
    """SELECT doc_id, strip_accents(text) AS plain,
       round(sqrt(CAST(doc_id AS DOUBLE) ** 2 + CAST(n_chars AS DOUBLE) ** 2), 6) AS length
       FROM documents""",
)
def sql_functions(spark, sf_dir):
    S.register_functions(spark)
    return spark.sql(
        """SELECT doc_id, remove_diacritics(text) AS plain,
           round(hypotenuse(doc_id, n_chars), 6) AS length FROM {d}""",
        d=table(spark, sf_dir, "documents"),
    )


@query(
    "alternating_bytes",
    r"""SELECT event_id, lower(regexp_replace(hex(props), '..(..)?', '01\1', 'g')) AS changed
        FROM events""",
)
def alternating_bytes(spark, sf_dir):
    changed = S.set_alternating_bytes(F.encode("props", "UTF-8"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.lower(F.hex(changed)).alias("changed")
    )


UPDATE = "o_orderstatus = 'P' AND o_totalprice < 100000"


@query(
    "conditional_update",
    f"""SELECT o_orderkey, CASE WHEN {UPDATE} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN {UPDATE} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def conditional_update(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return S.update(
        orders,
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") * 2},
        F.expr(UPDATE),
    )


@query("rows_changed", f"SELECT count(*) FILTER ({UPDATE}) AS changed FROM orders")
def rows_changed(spark, sf_dir):
    return S.rows_changed(table(spark, sf_dir, "orders"), F.expr(UPDATE))


@query(
    "like_prefix",
    """SELECT doc_id FROM documents WHERE translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
       'abcdefghijklmnopqrstuvwxyz') LIKE 'th%'""",
)
def like_prefix(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    return rows.where(S.like(F.col("text"), "tH%")).select("doc_id")
