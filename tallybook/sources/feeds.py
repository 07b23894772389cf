"""Transaction, telegram and change feeds derived from the warehouse tables.

Every feed is a narrow projection of one scan (plus a union or an explode), with discrepancies
injected by arithmetic on the key, so that any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIMARY = "core_banking"

# Id prefixes of the source systems (regular rows, rows only they have).
ID_PREFIXES = {"core_banking": ("CB-", None), "card_processor": ("CP-", "CX-"),
               "payment_gateway": ("PG-", "PX-")}
TYPES = ["deposit", "withdrawal", "transfer", "payment", "refund", "fee"]

# Discrepancy bucket (0-99) of a key: the card feed uses k, the gateway feed k * 7.
BUCKET_FACTOR = {"card_processor": 1, "payment_gateway": 7}

# Raw vocabularies: what a source writes before normalisation.
RAW_STATUS = {
    "card_processor": {"completed": "settled", "pending": "authorized", "failed": "declined",
                       "reversed": "chargeback"},
    "payment_gateway": {"completed": "SUCCESS", "pending": "IN_PROGRESS", "failed": "ERROR",
                        "reversed": "CANCELLED"},
}
RAW_TYPE = {"payment_gateway": {"payment": "charge", "refund": "credit"}}

TRANSACTION_COLUMNS = ["transaction_id", "source_system", "transaction_date", "amount",
                       "account_id", "transaction_type", "reference_id", "status", "payload",
                       "created_at", "processing_timestamp"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.expr("interval '1' second") * seconds


def _replaced(value: str, words: dict[str, str]) -> str:
    """SQL: the value, or its replacement."""
    cases = " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in words.items())
    return f"CASE {value} {cases} ELSE {value} END" if words else value


def _feed(orders: DataFrame) -> DataFrame:
    """The core feed with the order key ``k``."""
    when = "o_orderdate + interval '1' second * ((o_orderkey * 7919) % 86400)"
    types = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(TYPES))
    return orders.selectExpr(
        "concat('CB-', o_orderkey) AS transaction_id",
        f"'{PRIMARY}' AS source_system",
        f"{when} AS transaction_date",
        "CAST(o_totalprice AS decimal(18,2)) AS amount",
        "concat('ACC', o_custkey) AS account_id",
        f"CASE o_orderkey % 6 {types} END AS transaction_type",
        "concat('REF-', o_orderkey) AS reference_id",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' "
        "WHEN 'P' THEN 'failed' ELSE 'reversed' END AS status",
        "concat('{\"category\":\"', o_orderpriority, '\"}') AS payload",
        f"{when} - interval '1' second * ((o_orderkey % 60 + 1) * 60) AS created_at",
        f"{when} + interval '1' second * (o_orderkey % 30 + 1) AS processing_timestamp",
        "o_orderkey AS k",
    )


def primary_feed(orders: DataFrame) -> DataFrame:
    """The core banking feed: one transaction per order."""
    return _feed(orders).select(*TRANSACTION_COLUMNS)


def secondary_feed(orders: DataFrame, system: str = "card_processor",
                   raw: bool = False) -> DataFrame:
    """A second system's view of the same transactions, with injected discrepancies, plus
    transactions that only this system has. ``raw`` keeps the system's own vocabulary."""
    prefix, extra_prefix = ID_PREFIXES[system]
    # One pass: a key yields its copy (unless bucket 0) and sometimes an extra row. Bucket -1
    # below is an extra row, which no discrepancy applies to.
    rows = _feed(orders).selectExpr(
        "*", f"(k * {BUCKET_FACTOR[system]}) % 100 AS bucket",
    ).selectExpr("*", """explode(
        CASE WHEN bucket <> 0 AND k % 50 = 7 THEN array(bucket, -1L)
             WHEN bucket <> 0 THEN array(bucket)
             WHEN k % 50 = 7 THEN array(-1L) END) AS b""")
    shift = ("interval '1' second * "
             "(CASE WHEN b = 4 THEN 3600 WHEN b IN (5, 6) THEN 259200 ELSE 0 END)")

    def times(factor: str) -> str:
        return f"CAST(round(amount * CAST({factor} AS decimal(4,3)), 2) AS decimal(18,2))"

    status = ("CASE WHEN b <> 3 THEN status WHEN status = 'completed' THEN 'pending' "
              "ELSE 'completed' END")
    return rows.selectExpr(
        f"concat(if(b = -1, '{extra_prefix}', '{prefix}'), k) AS transaction_id",
        f"'{system}' AS source_system",
        f"transaction_date + {shift} AS transaction_date",
        f"CASE WHEN b IN (1, 6) THEN {times('1.005')} WHEN b = 2 THEN {times('1.030')} "
        "ELSE amount END AS amount",
        "if(b = -1, concat('X', account_id), account_id) AS account_id",
        _replaced("transaction_type", RAW_TYPE.get(system, {}) if raw else {})
        + " AS transaction_type",
        "if(b = -1, concat('REFX-', k), reference_id) AS reference_id",
        f"{status} AS status",
        "payload",
        f"created_at + {shift} AS created_at",
        f"processing_timestamp + {shift} AS processing_timestamp",
    ).selectExpr(*[
        f"{_replaced('status', RAW_STATUS[system])} AS status" if raw and c == "status" else c
        for c in TRANSACTION_COLUMNS])


def all_feeds(orders: DataFrame, raw: bool = False) -> DataFrame:
    """The transactions table: the three systems' rows together."""
    return (primary_feed(orders)
            .unionByName(secondary_feed(orders, "card_processor", raw))
            .unionByName(secondary_feed(orders, "payment_gateway", raw)))


def telegrams(events: DataFrame) -> DataFrame:
    """Telegrams: one per event, with a code, two parties and a handling time."""
    i = F.col("event_id")
    return events.select(
        i.cast("int").alias("Id"),
        (F.lit(1000) + i % 9000).cast("int").alias("TelegramCode"),
        (F.col("user_id") % 5 + 1).cast("int").alias("Source"),
        (i % 5 + 1).cast("int").alias("Destination"),
        F.col("ts").alias("DateIn"),
        F.when(i % 97 != 0, _plus_seconds(F.col("ts"), (i % 60 + 1) * 60)).alias("DateOut"),
        F.col("props").alias("Body"),
    )


def telegrams_of_months(events: DataFrame, months: int = 6) -> DataFrame:
    """The telegrams, dealt by Id over some months from their own on."""
    later = F.make_ym_interval(F.lit(0), F.col("Id") % months)
    return telegrams(events).withColumns({
        "DateIn": F.col("DateIn") + later, "DateOut": F.col("DateOut") + later})


def sent_messages(messages: DataFrame) -> DataFrame:
    """Messages with the time they were sent at; one in seven is sent again half a minute later."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset") / 10)
    again = F.when(F.col("offset") % 7 == 0, F.array(F.lit(0), F.lit(30))).otherwise(
        F.array(F.lit(0)))
    return messages.withColumn("late", F.explode(again)).select(
        "offset", "value", F.timestamp_seconds(
            F.unix_micros(at) / 1_000_000 + F.col("late")).alias("sent_at"))


def faulty_lines(transactions: DataFrame) -> DataFrame:
    """The feed as text, some rows with a value that is none, without an id, or a field too many
    when written without quotes."""
    k = F.regexp_extract("transaction_id", r"\d+", 0).cast("long")
    rows = transactions.select(k.alias("k"), *[F.col(c).cast("string").alias(c)
                                               for c in TRANSACTION_COLUMNS])
    k = F.col("k")
    return rows.withColumns({
        "amount": F.when(k % 97 == 0, "n/a").otherwise(F.col("amount")),
        "transaction_date": F.when(k % 89 == 0, "yesterday").otherwise(F.col("transaction_date")),
        "transaction_id": F.when(k % 83 != 0, F.col("transaction_id")),
        "status": F.when(k % 79 == 0, F.concat("status", F.lit(",twice"))).otherwise(
            F.col("status")),
    }).select(*TRANSACTION_COLUMNS)


def _text_time(ts: Column, layout: Column) -> Column:
    """The same time in one of the accepted layouts, in turn; layout -1 is not a time at all."""
    def fmt(pattern: str) -> Column:
        return F.date_format(ts, pattern)
    return (F.when(layout == 0, fmt("yyyy-MM-dd HH:mm:ss"))
            .when(layout == 1, fmt("yyyy-MM-dd HH:mm:ss.SSSSSS"))
            .when(layout == 2, fmt("yyyy-MM-dd'T'HH:mm:ss"))
            .when(layout == 3, fmt("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(layout == 4, fmt("yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(layout == 5, fmt("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
            .otherwise(F.lit("not a time")))


def _which(*candidates: tuple[int, Column | None]) -> Column:
    """Explode a row into the sequence numbers whose condition holds (None: always)."""
    return F.explode(F.filter(
        F.array(*[F.lit(n) if cond is None else F.when(cond, F.lit(n)) for n, cond in candidates]),
        lambda n: n.isNotNull()))


def change_messages(events: DataFrame) -> DataFrame:
    """Change-data-capture messages about telegrams: (offset, value). Inserts for all, some
    updates, some deletes, and hostile values: junk, null, no payload, no Id, bad times."""
    i, seq = F.col("Id"), F.col("seq")
    layout = F.when(i % 101 == 0, F.lit(-1)).otherwise(i % 6)
    rows = telegrams(events).select(
        "*",
        _text_time(F.col("DateIn"), layout).alias("text_in"),
        _text_time(F.col("DateOut"), layout).alias("text_out"),
        _which((0, None), (1, i % 50 == 3), (2, i % 50 == 9), (3, i % 200 == 11),
               (4, i % 200 == 12), (5, i % 200 == 13), (6, i % 200 == 14)).alias("seq"))

    def image(ident: Column, destination: Column) -> Column:
        return F.struct(
            ident.alias("Id"), F.col("TelegramCode"), F.col("Source"),
            destination.alias("Destination"), F.col("text_in").alias("DateIn"),
            F.col("text_out").alias("DateOut"), F.col("Body"))

    here = F.col("Destination")
    before = F.when(seq.isin(1, 2), image(i, here))
    after = F.when(seq.isin(0, 1, 6), image(
        F.when(seq != 6, i), F.when(seq == 1, here % 5 + 1).otherwise(here)))
    # Some messages name no operation.
    op = F.when(i % 37 == 5, F.when(seq == 2, "d")).when(seq == 1, "u").when(
        seq == 2, "d").otherwise("c")
    envelope = F.to_json(F.struct(F.struct(
        before.alias("before"), after.alias("after"), op.alias("op")).alias("payload")))
    value = (F.when(seq == 3, F.lit("this is not json"))
             .when(seq == 4, F.lit(None).cast("string"))
             .when(seq == 5, F.lit('{"schema":{"type":"struct"}}'))
             .otherwise(envelope))
    return rows.select((i.cast("long") * 10 + seq).alias("offset"), value.alias("value"))


def status_history(orders: DataFrame) -> DataFrame:
    """Row versions of the core feed: (transaction_id, commit_ts, seq, op, columns). Every row is
    inserted as pending, some are settled a day later, and some are deleted after ten days."""
    k, seq = F.col("k"), F.col("seq")
    rows = _feed(orders).select(
        "transaction_id", "transaction_date", "account_id", "amount", "status",
        _which((1, None), (2, k % 3 == 0), (3, k % 11 == 0)).alias("seq"))
    days = F.when(seq == 1, 0).when(seq == 2, 1).otherwise(10)
    return rows.select(
        "transaction_id",
        _plus_seconds(F.date_trunc("day", "transaction_date").cast("timestamp_ntz"),
                      days * 86400).alias("commit_ts"),
        seq,
        F.when(seq == 1, "c").when(seq == 2, "u").otherwise("d").alias("op"),
        "account_id", "amount",
        F.when(seq == 1, "pending").when(seq == 2, F.col("status")).alias("status"),
    )
