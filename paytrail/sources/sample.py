"""Payment inputs derived from the sample tables orders and lineitem, defects included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One event for each order, and one for each of its lines, over columns k, custkey, auth and rn.
PROCESSOR = "concat('processor-0', {k} % 3 + 1)"
CURRENCY = "element_at(array('INR', 'USD', 'EUR', 'GBP'), cast({k} % 4 + 1 AS int))"
HEAD_TYPE = "CASE WHEN k % 137 = 0 THEN 'refund' WHEN k % 139 = 0 OR k % 113 = 0 THEN 'capture' ELSE 'authorization' END"
LINE_TYPE = "CASE WHEN k % 137 = 0 THEN 'refund' WHEN rn = 1 AND (k % 139 = 0 OR k % 109 = 0) THEN 'authorization' ELSE et END"
LINE_VERSION = "CASE WHEN k % 131 = 0 THEN rn WHEN k % 127 = 0 THEN rn + 2 ELSE rn + 1 END"
CAPTURED = """CASE WHEN k % 3 = 0 THEN floor(auth / (2.0D * ncap)) WHEN k % 13 = 0 THEN auth
  WHEN rn = 1 AND k % 11 <> 0 THEN auth - floor(auth / cast(ncap AS double)) * (ncap - 1) ELSE floor(auth / cast(ncap AS double)) END"""
REVERSED = "CASE WHEN k % 4 = 0 THEN floor(auth / cast(nrev AS double)) ELSE floor(auth / (8.0D * nrev)) END"


def payment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived view: an event history of a payment for each order.

    Orders and lines are exchanged by transaction, once; what is grouped, joined or windowed by transaction after that needs no other exchange.
    """
    transaction_id = F.concat(F.lit("txn-"), "k").alias("transaction_id")
    number = F.substring("transaction_id", 5, 20).cast("long").alias("k")  # not sent beside the text that holds it
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"), F.round(F.col("o_totalprice") * 100).cast("long").alias("auth"), F.col("o_orderdate").alias("event_time")
    )
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_orderkey", "k")
    et = F.when(F.col("l_returnflag") != "R", "capture").when(F.col("l_linestatus") == "F", "refund").otherwise("chargeback")
    late = F.when(F.col("k") % 11 == 0, 0).when(F.col("l_returnflag") == "R", 1).otherwise(0)
    of_order = Window.partitionBy("transaction_id")
    in_order = Window.partitionBy("k", "transaction_id").orderBy(late, *(f"l_{c}" for c in ("linenumber", "partkey", "suppkey", "shipdate", "extendedprice", "quantity", "returnflag", "linestatus")))
    counted = lines.withColumn("transaction_id", transaction_id).drop("k").withColumns({"et": et, "ncap": F.sum(F.when(et == "capture", 1).otherwise(0)).over(of_order), "nrev": F.sum(F.when(et == "capture", 0).otherwise(1)).over(of_order)})
    # The counts make the exchange by transaction; within it, lines are put in order by number first, which is faster than by text.
    numbered = counted.withColumn("k", number).select("transaction_id", "et", F.row_number().over(in_order).alias("rn"), "ncap", "nrev")
    joined = orders.select("*", transaction_id).drop("k").join(numbered, "transaction_id", "left").withColumn("k", number)
    # An order's head comes with its first line, or alone.
    parts = joined.selectExpr("*", "explode(CASE WHEN rn IS NULL THEN array(0) WHEN rn = 1 THEN array(0, 1) ELSE array(rn) END) AS seq")
    body = f"greatest(1L, cast(CASE WHEN et = 'capture' THEN {CAPTURED} ELSE {REVERSED} END AS long))"
    told = parts.selectExpr(
        "transaction_id",
        "k",
        "custkey",
        "event_time",
        "seq",
        f"CASE WHEN seq = 0 THEN 1L ELSE cast({LINE_VERSION} AS long) END AS version",
        f"CASE WHEN seq = 0 THEN {HEAD_TYPE} ELSE {LINE_TYPE} END AS kind",
        f"CASE WHEN seq = 0 THEN auth ELSE {body} END AS amount",
        "CASE WHEN seq > 0 AND k % 101 = 0 THEN 1L ELSE 0L END AS p",
        "CASE WHEN seq > 0 AND k % 107 = 0 THEN 1L ELSE 0L END AS m",
        "CASE WHEN seq > 0 AND k % 103 = 0 THEN 1L ELSE 0L END AS c",
    )
    return told.selectExpr(
        "concat('txn-', k, ':e', seq) AS event_id",
        "transaction_id",
        "version AS transaction_version",
        "kind AS event_type",
        "amount AS amount_minor",
        f"{PROCESSOR.format(k='(k + p)')} AS processor_id",
        "concat('merchant-', (custkey + m) % 250) AS merchant_id",
        f"{CURRENCY.format(k='(k + c)')} AS currency",
        "event_time",
        "k",
        "seq",
        "custkey",
    )


#: For each residue of k % 97, a defect of the head event's JSON: field to set (or drop) and its JSON value.
DEFECTS = (
    (1, "card_number", '"4111111111111111"'),
    (2, "merchant_id", None),
    (3, "surprise", "1"),
    (4, "schema_version", '"9.9"'),
    (5, "event_id", '"bad id"'),
    (6, "processor_id", '"p/1"'),
    (7, "source_id", '"nobody-01"'),
    (8, "source_id", '"processor_settlement-01"'),
    (9, "transaction_version", "0"),
    (10, "event_type", '"void"'),
    (11, "amount_minor", "100.25"),
    (12, "currency", '"JPY"'),
    (13, "event_time", '"yesterday"'),
    (14, "received_at", '"2026-01-01T00:00:00"'),
    (15, "customer_email", '"nobody"'),
    (16, "amount_minor", "true"),
)


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ordinal, value) JSON arrivals: the view's events with defects, exact replays (k % 83) and conflicts (k % 89)."""
    events = payment_events(spark, sf_dir)
    iso = "date_format({t}, \"yyyy-MM-dd'T'HH:mm:ss\") || '+00:00'"
    fields = {
        "amount_minor": "cast(amount_minor + bump AS string)",
        "currency": "'\"' || currency || '\"'",
        "customer_email": "'\"Customer' || custkey % 10000 || '@Example.test\"'",
        "event_id": "'\"' || event_id || '\"'",
        "event_time": f"'\"' || {iso.format(t='event_time')} || '\"'",
        "event_type": "'\"' || event_type || '\"'",
        "merchant_id": "'\"' || merchant_id || '\"'",
        "processor_id": "'\"' || processor_id || '\"'",
        "received_at": f"'\"' || {iso.format(t='timestampadd(SECOND, k % 240 + 60 * copy, event_time)')} || '\"'",
        "schema_version": "'\"1.0\"'",
        "source_id": "'\"checkout-0' || (k % 5 + 1) || '\"'",
        "transaction_id": "'\"' || transaction_id || '\"'",
        "transaction_version": "cast(transaction_version AS string)",
    }
    extra = ("card_number", "surprise")
    parts = []
    for name in sorted([*fields, *extra]):
        own = [(n, value) for n, field, value in DEFECTS if field == name]
        cases = " ".join(f"WHEN seq = 0 AND k % 97 = {n} THEN " + ("NULL" if v is None else f"'\"{name}\":{v}'") for n, v in own)
        plain = f"'\"{name}\":' || {fields[name]}" if name in fields else "NULL"
        parts.append(f"CASE {cases} ELSE {plain} END" if cases else plain)
    copies = events.selectExpr("*", "explode(CASE WHEN seq = 0 AND k % 83 = 0 THEN array(0, 1) WHEN seq = 0 AND k % 89 = 0 THEN array(0, 2) ELSE array(0) END) AS copy")
    bumped = copies.selectExpr("*", "CASE WHEN copy = 2 THEN 1 ELSE 0 END AS bump")
    return bumped.selectExpr("cast((k * 64 + seq) * 4 + copy AS long) AS ordinal", f"'{{' || concat_ws(',', {', '.join(parts)}) || '}}' AS value")


#: A number that tells the cases of an arrival's envelope and surroundings apart.
CASE_NUMBER = "(ordinal div 256 + ordinal div 4 % 64 + ordinal % 4) % 10"


def cdc_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival in a change-data envelope: inserts and loads, updates, other tables, broken envelopes and none."""
    raw = raw_arrivals(spark, sf_dir)
    table = f"CASE WHEN {CASE_NUMBER} = 7 THEN 'other_table' ELSE 'payment_outbox' END"
    operation = f"CASE WHEN {CASE_NUMBER} = 8 THEN 'update' WHEN {CASE_NUMBER} % 2 = 0 THEN 'insert' ELSE 'load' END"
    return raw.selectExpr(
        "ordinal",
        f"""CASE WHEN {CASE_NUMBER} = 9 THEN '{{"metadata":1,"data":' || value || '}}' WHEN {CASE_NUMBER} = 6 THEN value
          ELSE '{{"metadata":{{"table-name":"' || {table} || '","operation":"' || {operation} || '"}},"data":' || value || '}}' END AS value""",
    )


def nested_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival inside another payload, of which half have prohibited keys of their own at several depths."""
    cards = '"list":[{"CVV":"1","deep":{"Card_Number":"4"}}],'
    return raw_arrivals(spark, sf_dir).selectExpr(
        "ordinal", f"""'{{"customer_email":"A@b.c","held":[' || value || '],' || CASE WHEN {CASE_NUMBER} < 5 THEN '{cards}' ELSE '' END || '"note":"\\\\"pin\\\\": 1"}}' AS value"""
    )


def settlement_evidence(expected: DataFrame) -> DataFrame:
    """Evidence made from expectations: some groups missing, some 101 short, and a processor nobody expects."""
    day = F.dayofmonth("business_date")
    kept = expected.filter(~((day % 7 == 3) & (F.col("currency") == "EUR")))
    shifted = kept.select(
        F.lit("1.0").alias("schema_version"), "business_date", "processor_id", "currency", (F.col("expected_minor") - F.when((day % 5 == 0) & (F.col("processor_id") == "processor-02"), 101).otherwise(0)).alias("amount_minor")
    )
    extra = kept.select("business_date").distinct().select(F.lit("1.0").alias("schema_version"), "business_date", F.lit("processor-99").alias("processor_id"), F.lit("INR").alias("currency"), F.lit(500).cast("long").alias("amount_minor")).filter(F.dayofmonth("business_date") == 1)
    return shifted.unionByName(extra)
