"""The same queries as plain SQL over the same tables, for checking with another engine."""

from __future__ import annotations

CORE = """
core AS (
  SELECT 'CB-' || o_orderkey AS transaction_id, 'core_banking' AS source_system,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS transaction_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount, 'ACC' || o_custkey AS account_id,
         CASE o_orderkey % 6 WHEN 0 THEN 'deposit' WHEN 1 THEN 'withdrawal'
              WHEN 2 THEN 'transfer' WHEN 3 THEN 'payment' WHEN 4 THEN 'refund'
              ELSE 'fee' END AS transaction_type,
         'REF-' || o_orderkey AS reference_id,
         CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
              WHEN 'P' THEN 'failed' ELSE 'reversed' END AS status,
         '{"category":"' || o_orderpriority || '"}' AS payload,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400)
           - to_seconds((o_orderkey % 60 + 1) * 60) AS created_at,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400)
           + to_seconds(o_orderkey % 30 + 1) AS processing_timestamp
  FROM orders)"""

TX = ("transaction_id, source_system, transaction_date, amount, account_id, transaction_type, "
      "reference_id, status, payload, created_at, processing_timestamp")


def _second(name: str, system: str, prefix: str, extra: str, factor: int) -> str:
    return f"""
{name}_keys AS (
  SELECT core.*, CAST(substr(transaction_id, 4) AS BIGINT) AS k,
         (CAST(substr(transaction_id, 4) AS BIGINT) * {factor}) % 100 AS b FROM core),
{name}_shifted AS (
  SELECT *, to_seconds(CASE WHEN b = 4 THEN 3600 WHEN b IN (5, 6) THEN 259200 ELSE 0 END)
         AS shift FROM {name}_keys WHERE b <> 0),
{name} AS (
  SELECT '{prefix}' || k AS transaction_id, '{system}' AS source_system,
         transaction_date + shift AS transaction_date,
         CASE WHEN b IN (1, 6)
              THEN CAST(round(amount * CAST(1.005 AS DECIMAL(4,3)), 2) AS DECIMAL(18,2))
              WHEN b = 2
              THEN CAST(round(amount * CAST(1.030 AS DECIMAL(4,3)), 2) AS DECIMAL(18,2))
              ELSE amount END AS amount,
         account_id, transaction_type, reference_id,
         CASE WHEN b = 3 THEN CASE status WHEN 'completed' THEN 'pending' ELSE 'completed' END
              ELSE status END AS status,
         payload, created_at + shift AS created_at,
         processing_timestamp + shift AS processing_timestamp
  FROM {name}_shifted
  UNION ALL
  SELECT '{extra}' || k, '{system}', transaction_date, amount, 'X' || account_id,
         transaction_type, 'REFX-' || k, status, payload, created_at, processing_timestamp
  FROM {name}_keys WHERE k % 50 = 7)"""


CARD = _second("card", "card_processor", "CP-", "CX-", 1)
GATE = _second("gate", "payment_gateway", "PG-", "PX-", 7)
RAW_CARD_COLUMNS = """transaction_id, source_system, transaction_date, amount, account_id,
  transaction_type, reference_id,
  CASE status WHEN 'completed' THEN 'settled' WHEN 'pending' THEN 'authorized'
       WHEN 'failed' THEN 'declined' WHEN 'reversed' THEN 'chargeback' ELSE status END AS status,
  payload, created_at, processing_timestamp"""
RAW_GATE_COLUMNS = """transaction_id, source_system, transaction_date, amount, account_id,
  CASE transaction_type WHEN 'payment' THEN 'charge' WHEN 'refund' THEN 'credit'
       ELSE transaction_type END AS transaction_type, reference_id,
  CASE status WHEN 'completed' THEN 'SUCCESS' WHEN 'pending' THEN 'IN_PROGRESS'
       WHEN 'failed' THEN 'ERROR' WHEN 'reversed' THEN 'CANCELLED' ELSE status END AS status,
  payload, created_at, processing_timestamp"""
ALL = f"""
tx AS (SELECT {TX} FROM core UNION ALL SELECT {TX} FROM card UNION ALL SELECT {TX} FROM gate)"""
ALL_RAW = f"""
raw AS (SELECT {TX} FROM core UNION ALL SELECT {RAW_CARD_COLUMNS} FROM card
        UNION ALL SELECT {RAW_GATE_COLUMNS} FROM gate)"""
FEEDS = f"WITH {CORE},{CARD},{GATE},{ALL}"
PAIR = f"WITH {CORE},{CARD}"
PAIR_GATE = f"WITH {CORE},{GATE}"
RAW = f"WITH {CORE},{CARD},{GATE},{ALL_RAW}"


def _epoch(column: str) -> str:
    return f"CAST(floor(epoch({column})) AS BIGINT)"


def _apart(a: str, b: str) -> str:
    return f"abs({_epoch(a)} - {_epoch(b)})"


def _within(p: str, s: str) -> str:
    return f"abs({p}.amount - {s}.amount) <= {p}.amount * CAST(0.01 AS DECIMAL(10,8))"


SAME = ("p.account_id = s.account_id AND p.amount = s.amount "
        "AND p.transaction_type = s.transaction_type AND p.status = s.status")
GROUP = "p.account_id = s.account_id AND p.transaction_type = s.transaction_type"
SCORE = (f"1.0::DOUBLE - 0.5::DOUBLE * CASE WHEN p.amount = s.amount THEN 0.0::DOUBLE ELSE "
         "CAST(abs(p.amount - s.amount) AS DOUBLE) / CAST(p.amount AS DOUBLE) END "
         f"- 0.5::DOUBLE * (CAST({_apart('p.transaction_date', 's.transaction_date')} AS DOUBLE)"
         " / 86400.0::DOUBLE)")
SIDES = """p.transaction_id AS primary_transaction_id,
         s.transaction_id AS secondary_transaction_id, p.account_id,
         p.amount AS primary_amount, s.amount AS secondary_amount, p.transaction_type,
         p.transaction_date AS primary_transaction_date,
         s.transaction_date AS secondary_transaction_date, p.status AS primary_status,
         s.status AS secondary_status"""
CLASSES = """CASE WHEN primary_amount = secondary_amount AND primary_status = secondary_status
              THEN 'MATCHED' ELSE 'PARTIAL' END AS match_status,
         CASE WHEN primary_amount <> secondary_amount THEN 'AMOUNT'
              WHEN primary_status <> secondary_status THEN 'STATUS' END AS discrepancy_type,
         CASE WHEN primary_amount <> secondary_amount
              THEN CAST(abs(primary_amount - secondary_amount) AS DECIMAL(18,2)) END
           AS discrepancy_amount"""


def _hybrid(n: str, p: str, s: str) -> str:
    """CTEs of the hybrid matching of feeds p and s: {n}_pairs, {n}_up, {n}_us."""
    return f"""
{n}_exact AS (SELECT {SIDES} FROM {p} p JOIN {s} s ON {SAME}),
{n}_lp AS (SELECT * FROM {p} p WHERE NOT EXISTS (SELECT 1 FROM {s} s WHERE {SAME})),
{n}_ls AS (SELECT * FROM {s} s WHERE NOT EXISTS (SELECT 1 FROM {p} p WHERE {SAME})),
{_fuzzy(n, f'{n}_lp', f'{n}_ls')},
{n}_pairs AS (SELECT *, {CLASSES} FROM (
  SELECT * FROM {n}_exact UNION ALL SELECT * FROM {n}_best)),
{n}_up AS (SELECT * FROM {n}_lp WHERE transaction_id NOT IN
  (SELECT primary_transaction_id FROM {n}_best)),
{n}_us AS (SELECT * FROM {n}_ls WHERE transaction_id NOT IN
  (SELECT secondary_transaction_id FROM {n}_best))"""


def _fuzzy(n: str, p: str, s: str) -> str:
    return f"""
{n}_cand AS (
  SELECT {SIDES}, {SCORE} AS score FROM {p} p JOIN {s} s ON {GROUP}
  AND {_within('p', 's')} AND {_apart('p.transaction_date', 's.transaction_date')} <= 86400),
{n}_best AS (
  SELECT * EXCLUDE (score, rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY primary_transaction_id ORDER BY score DESC, secondary_transaction_id) AS rn
    FROM {n}_cand) WHERE rn = 1)"""


def _results(n: str, source: str, batch: str) -> str:
    """Results of hybrid n; ``batch`` is an expression of a row's time {at}."""
    def key(pid: str, sid: str, b: str) -> str:
        return (f"sha256({b} || '|{source}|' || coalesce({pid}, '') || '|' "
                f"|| coalesce({sid}, ''))")

    both = f"core_banking and {source}"
    pair_batch = batch.format(at="primary_transaction_date")
    row_batch = batch.format(at="transaction_date")
    return f"""
{n}_results AS (
  SELECT {key('primary_transaction_id', 'secondary_transaction_id', pair_batch)}
           AS reconciliation_id, {pair_batch} AS batch_id, primary_transaction_id,
         secondary_transaction_id, match_status, discrepancy_type, discrepancy_amount,
         primary_transaction_date AS reconciliation_timestamp,
         CASE WHEN match_status = 'PARTIAL' THEN 'Partial match between {both}. ' ||
           CASE discrepancy_type
             WHEN 'AMOUNT' THEN 'Amount discrepancy: ' || CAST(discrepancy_amount AS VARCHAR)
             WHEN 'STATUS' THEN 'Status discrepancy: Primary=' || primary_status
                                || ', Secondary=' || secondary_status
             ELSE '' END
           ELSE 'Exact match between {both}' END AS notes
  FROM {n}_pairs
  UNION ALL
  SELECT {key('transaction_id', "NULL", row_batch)}, {row_batch}, transaction_id, NULL,
         'UNMATCHED', 'MISSING_SECONDARY', amount, transaction_date,
         'Transaction in core_banking not found in {source}' FROM {n}_up
  UNION ALL
  SELECT {key("NULL", 'transaction_id', row_batch)}, {row_batch}, NULL, transaction_id,
         'UNMATCHED', 'MISSING_PRIMARY', amount, transaction_date,
         'Transaction in {source} not found in core_banking' FROM {n}_us)"""


_ONE_BATCH = "'RECON-1'"
HYBRID = f"{PAIR},{_hybrid('h', 'core', 'card')}"
RECON = f"{HYBRID},{_results('h', 'card_processor', _ONE_BATCH)}"
STAR = (f"WITH {CORE},{CARD},{GATE},{ALL},"
        f"{_hybrid('hc', 'core', 'card')},{_hybrid('hg', 'core', 'gate')},"
        + _results("hc", "card_processor", "('CARD-' || strftime({at}, '%Y-%m'))")
        + "," + _results("hg", "payment_gateway", "('GATE-' || strftime({at}, '%Y-%m'))")
        + ",\nresults AS (SELECT * FROM hc_results UNION ALL SELECT * FROM hg_results)")
BATCHES = """
months AS (
  SELECT strftime(transaction_date, '%Y-%m') AS month, min(transaction_date) AS start_date,
         max(transaction_date) AS end_date, count(*) AS n FROM core GROUP BY 1),
batches AS (
  SELECT prefix || month AS batch_id, end_date AS reconciliation_date,
         'core_banking,' || system AS source_systems, start_date, end_date, status,
         n AS total_transactions, CAST(0 AS BIGINT) AS matched_count,
         CAST(0 AS BIGINT) AS unmatched_count, start_date AS created_at,
         CASE WHEN status = 'COMPLETED' THEN end_date END AS completed_at
  FROM (SELECT *, CASE CAST(substr(month, 6, 2) AS INTEGER) % 4 WHEN 0 THEN 'PENDING'
               WHEN 1 THEN 'IN_PROGRESS' WHEN 2 THEN 'COMPLETED' ELSE 'FAILED' END AS status
        FROM months), (VALUES ('CARD-', 'card_processor'), ('GATE-', 'payment_gateway'))
        AS v(prefix, system))"""
TOTALS = ("count(*) AS count, CAST(sum(coalesce(discrepancy_amount, 0)) AS DECIMAL(28,2)) "
          "AS total_discrepancy_amount")
TELEGRAMS = """
tele AS (
  SELECT CAST(event_id AS INTEGER) AS Id, CAST(1000 + event_id % 9000 AS INTEGER) AS TelegramCode,
         CAST(user_id % 5 + 1 AS INTEGER) AS Source,
         CAST(event_id % 5 + 1 AS INTEGER) AS Destination, ts AS DateIn,
         CASE WHEN event_id % 97 <> 0 THEN ts + to_minutes(event_id % 60 + 1) END AS DateOut,
         props AS Body FROM events)"""
TELE = f"WITH {TELEGRAMS}"
MINUTES = "(epoch_us(DateOut) - epoch_us(DateIn)) / 60000000.0::DOUBLE"
WHOLE = "CAST(trunc((epoch_us(DateOut) - epoch_us(DateIn)) / 60000000.0) AS BIGINT)"
HANDLED = "DateOut IS NOT NULL AND DateIn IS NOT NULL"
HISTORY = """
history AS (
  SELECT transaction_id, date_trunc('day', transaction_date) + to_days(CAST(days AS INTEGER))
           AS commit_ts, CAST(seq AS INTEGER) AS seq, op, account_id, amount,
         CASE seq WHEN 1 THEN 'pending' WHEN 2 THEN status END AS status
  FROM (SELECT *, CAST(substr(transaction_id, 4) AS BIGINT) AS k FROM core),
       (VALUES (1, 'c', 0), (2, 'u', 1), (3, 'd', 10)) AS v(seq, op, days)
  WHERE seq = 1 OR (seq = 2 AND k % 3 = 0) OR (seq = 3 AND k % 11 = 0))"""
HIST = f"WITH {CORE},{HISTORY}"
HISTORY_COLUMNS = "transaction_id, commit_ts, seq, op, account_id, amount, status"


def _newest(where: str) -> str:
    return (f"SELECT {HISTORY_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"transaction_id ORDER BY commit_ts DESC, seq DESC) AS rn FROM history "
            f"WHERE {where}) WHERE rn = 1")


IMAGES = """
images AS (
  SELECT Id, TelegramCode, Source, Destination,
         CASE WHEN Id % 101 = 0 THEN NULL WHEN Id % 6 IN (0, 2, 4)
              THEN date_trunc('second', DateIn) ELSE DateIn END AS DateIn,
         CASE WHEN Id % 101 = 0 THEN NULL WHEN Id % 6 IN (0, 2, 4)
              THEN date_trunc('second', DateOut) ELSE DateOut END AS DateOut, Body FROM tele)"""
CDC = f"WITH {TELEGRAMS},{IMAGES}"
TELE_COLUMNS = "Id, TelegramCode, Source, Destination, DateIn, DateOut, Body"
MOVED = ("Id, TelegramCode, Source, CAST(Destination % 5 + 1 AS INTEGER) AS Destination, "
         "DateIn, DateOut, Body")
CDC_DECODED = f"""{CDC} SELECT {TELE_COLUMNS} FROM images
  UNION ALL SELECT {MOVED} FROM images WHERE Id % 50 = 3"""
CDC_REJECTED = f"""{TELE} SELECT CAST(Id AS BIGINT) * 10 + n AS "offset", reason FROM tele,
  (VALUES (2, 'no after image', 50, 9), (3, 'not json', 200, 11), (4, 'empty', 200, 12),
          (5, 'no payload', 200, 13), (6, 'no id', 200, 14)) AS v(n, reason, m, r)
  WHERE Id % m = r"""
# One primary after the other, per account, with the secondaries taken so far.
def _one_to_one() -> str:
    """CTEs of the four-step rule; the last is pairs(pid, sid)."""
    unit = "CAST(floor(cents / 100.0) AS BIGINT)"
    steps = [("cents", "id"), (unit, "cents, id")]
    for shift in (0, 1):
        couple = f"CAST(floor(({unit} + {shift}) / 2.0) AS BIGINT)"
        steps.append((couple, f"abs(cents - (2 * {couple} + 1 - {shift}) * 100), id"))
    ctes = ["""left0 AS (
  SELECT account_id, transaction_id AS id, CAST(amount * 100 AS BIGINT) AS cents, TRUE AS is_p
  FROM core UNION ALL SELECT account_id, transaction_id, CAST(amount * 100 AS BIGINT), FALSE
  FROM card)"""]
    for k, (cell, order) in enumerate(steps):
        ctes.append(f"""ranked{k} AS (SELECT *, {cell} AS cell, row_number() OVER (
  PARTITION BY account_id, {cell}, is_p ORDER BY {order}) AS turn FROM left{k}),
pairs{k} AS (SELECT p.id AS pid, s.id AS sid
  FROM ranked{k} p JOIN ranked{k} s USING (account_id, cell, turn)
  WHERE p.is_p AND NOT s.is_p AND abs(p.cents - s.cents) <= 100),
left{k + 1} AS (SELECT account_id, id, cents, is_p FROM left{k}
  WHERE id NOT IN (SELECT pid FROM pairs{k}) AND id NOT IN (SELECT sid FROM pairs{k}))""")
    ctes.append("pairs AS (" + " UNION ALL ".join(f"SELECT * FROM pairs{k}" for k in range(4))
                + ")")
    return ",\n".join(ctes)


GREEDY = f"""WITH {CORE},{CARD},{_one_to_one()},
sides AS (
  SELECT 'PAIR' AS outcome, {SIDES}
  FROM pairs JOIN core p ON p.transaction_id = pid JOIN card s ON s.transaction_id = sid
  UNION ALL
  SELECT 'PRIMARY_ONLY', transaction_id, NULL, account_id, amount, NULL, transaction_type,
         transaction_date, NULL, status, NULL FROM core
  WHERE transaction_id NOT IN (SELECT pid FROM pairs)
  UNION ALL
  SELECT 'SECONDARY_ONLY', NULL, transaction_id, account_id, NULL, amount, transaction_type,
         NULL, transaction_date, NULL, status FROM card
  WHERE transaction_id NOT IN (SELECT sid FROM pairs))
SELECT * EXCLUDE (match_status, discrepancy_type, discrepancy_amount),
  CASE WHEN outcome = 'PAIR' THEN match_status ELSE 'UNMATCHED' END AS match_status,
  CASE outcome WHEN 'PRIMARY_ONLY' THEN 'MISSING_SECONDARY'
       WHEN 'SECONDARY_ONLY' THEN 'MISSING_PRIMARY' ELSE discrepancy_type END
    AS discrepancy_type,
  CASE outcome WHEN 'PRIMARY_ONLY' THEN primary_amount WHEN 'SECONDARY_ONLY'
       THEN secondary_amount ELSE discrepancy_amount END AS discrepancy_amount
FROM (SELECT *, {CLASSES} FROM sides)"""
LO, HI = "TIMESTAMP '1996-03-01 00:00:00'", "TIMESTAMP '1998-09-30 12:00:00'"
CUT, AS_OF = "TIMESTAMP '1999-01-01 00:00:00'", "TIMESTAMP '1998-06-15 00:00:00'"
STANDARD_STATUS = """CASE
  WHEN status IN ('completed', 'COMPLETED', 'success', 'SUCCESS') THEN 'completed'
  WHEN status IN ('pending', 'PENDING', 'in_progress', 'IN_PROGRESS') THEN 'pending'
  WHEN status IN ('failed', 'FAILED', 'error', 'ERROR') THEN 'failed'
  WHEN status IN ('reversed', 'REVERSED', 'cancelled', 'CANCELLED') THEN 'reversed'
  ELSE status END"""
SOURCE_STATUS = f"""CASE source_system || ':' || {STANDARD_STATUS}
  WHEN 'card_processor:authorized' THEN 'pending' WHEN 'card_processor:settled' THEN 'completed'
  WHEN 'card_processor:declined' THEN 'failed' WHEN 'card_processor:chargeback' THEN 'reversed'
  ELSE {STANDARD_STATUS} END"""
SOURCE_TYPE = """CASE source_system || ':' || transaction_type
  WHEN 'payment_gateway:charge' THEN 'payment' WHEN 'payment_gateway:credit' THEN 'refund'
  ELSE transaction_type END"""
CATEGORY = """CASE transaction_type WHEN 'deposit' THEN 'INCOME' WHEN 'withdrawal' THEN 'EXPENSE'
  WHEN 'transfer' THEN 'TRANSFER' WHEN 'payment' THEN 'EXPENSE' WHEN 'refund' THEN 'INCOME'
  WHEN 'fee' THEN 'FEE' ELSE 'OTHER' END"""
ENRICHED = f"""CAST(transaction_date AS DATE) AS transaction_day,
  strftime(transaction_date, '%Y-%m') AS transaction_month,
  {_epoch('processing_timestamp')} - {_epoch('transaction_date')} AS processing_lag_seconds"""
RULE_IDS = ("p.transaction_id AS p_transaction_id, s.transaction_id AS s_transaction_id, "
            "p.reference_id AS p_reference_id, s.reference_id AS s_reference_id")
RULE_DATE = (f"{GROUP} AND p.amount = s.amount AND "
             f"{_apart('p.transaction_date', 's.transaction_date')} <= 86400")
RULE_STATUS = f"{GROUP} AND p.amount = s.amount"
RULE_AMOUNT = f"{GROUP} AND {_within('p', 's')}"
TYPE_AMOUNT = "CASE WHEN p.amount <> s.amount THEN 'AMOUNT' END"
TYPE_DATE = "CASE WHEN p.transaction_date <> s.transaction_date THEN 'DATE' END"
TYPE_STATUS = "CASE WHEN p.status <> s.status THEN 'STATUS' END"
DISC_COLUMNS = ("reconciliation_id, batch_id, primary_transaction_id, secondary_transaction_id, "
                "match_status, discrepancy_type, discrepancy_amount, reconciliation_timestamp, "
                "notes")


def _tagged(name: str, on: str, kind: str) -> str:
    return (f"SELECT '{name}' AS rule_name, p.transaction_id AS p_transaction_id, "
            f"s.transaction_id AS s_transaction_id, {kind} AS discrepancy_type "
            f"FROM core p JOIN card s ON {on}")


def _json_time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


TX_JSON = f"""{PAIR} SELECT '{{"transaction_id":"' || transaction_id || '","source_system":"'
  || source_system || '","transaction_date":"' || {_json_time('transaction_date')}
  || '","amount":"' || CAST(amount AS VARCHAR) || '","account_id":"' || account_id
  || '","transaction_type":"' || transaction_type || '","reference_id":"' || reference_id
  || '","status":"' || status || '","payload":"' || replace(payload, '"', '\\"')
  || '","created_at":"' || {_json_time('created_at')} || '","processing_timestamp":"'
  || {_json_time('processing_timestamp')} || '"}}' AS value FROM core"""


def _series(period: str) -> str:
    return (f"{STAR} SELECT {period} AS period, match_status, {TOTALS} FROM results GROUP BY 1, 2")


SQL: dict[str, str] = {
    "flagship": f"{RECON} SELECT batch_id, match_status, {TOTALS} FROM h_results GROUP BY 1, 2",
    "exact_match": f"""{PAIR} SELECT {SIDES}, 'MATCHED' AS match_status,
        CAST(NULL AS VARCHAR) AS discrepancy_type,
        CAST(NULL AS DECIMAL(18,2)) AS discrepancy_amount
        FROM core p JOIN card s ON {SAME}""",
    "unmatched_primary": f"""{PAIR} SELECT {TX} FROM core p
        WHERE NOT EXISTS (SELECT 1 FROM card s WHERE {SAME})""",
    "unmatched_secondary": f"""{PAIR} SELECT {TX} FROM card s
        WHERE NOT EXISTS (SELECT 1 FROM core p WHERE {SAME})""",
    "fuzzy_candidates": f"""{PAIR} SELECT p.transaction_id AS primary_transaction_id,
        s.transaction_id AS secondary_transaction_id, p.account_id, p.transaction_type,
        CAST(abs(p.amount - s.amount) AS DECIMAL(18,2)) AS amount_diff,
        {_apart('p.transaction_date', 's.transaction_date')} AS date_diff_seconds
        FROM core p JOIN card s ON {GROUP} AND {_within('p', 's')}
        AND {_apart('p.transaction_date', 's.transaction_date')} <= 86400""",
    "fuzzy_best": f"{PAIR},{_fuzzy('f', 'core', 'card')} SELECT *, {CLASSES} FROM f_best",
    "hybrid_match": f"{HYBRID} SELECT * FROM h_pairs",
    "hybrid_match_gateway":
        f"{PAIR_GATE},{_hybrid('h', 'core', 'gate')} SELECT * FROM h_pairs",
    "recon_results": f"{RECON} SELECT * EXCLUDE (reconciliation_timestamp) FROM h_results",
    "multi_source_results": f"{STAR} SELECT * FROM results",
    "greedy_one_to_one": GREEDY,
    "rule_exact": f"{PAIR} SELECT {RULE_IDS} FROM core p JOIN card s ON {SAME}",
    "rule_amount": f"""{PAIR} SELECT {RULE_IDS}, {TYPE_AMOUNT} AS discrepancy_type,
        CASE WHEN p.amount <> s.amount THEN CAST(abs(p.amount - s.amount) AS DECIMAL(18,2)) END
        AS discrepancy_amount FROM core p JOIN card s ON {RULE_AMOUNT}""",
    "rule_date": f"""{PAIR} SELECT {RULE_IDS}, {TYPE_DATE} AS discrepancy_type,
        CASE WHEN p.transaction_date <> s.transaction_date THEN
        {_apart('p.transaction_date', 's.transaction_date')} END AS date_diff_seconds
        FROM core p JOIN card s ON {RULE_DATE}""",
    "rule_status": f"""{PAIR} SELECT {RULE_IDS}, {TYPE_STATUS} AS discrepancy_type,
        CASE WHEN p.status <> s.status THEN 'Status discrepancy: Primary=' || p.status
        || ', Secondary=' || s.status END AS notes FROM core p JOIN card s ON {RULE_STATUS}""",
    "rule_reference":
        f"{PAIR} SELECT {RULE_IDS} FROM core p JOIN card s ON p.reference_id = s.reference_id",
    "rules_tagged": PAIR + " " + " UNION ALL ".join([
        _tagged("exact_match", SAME, "CAST(NULL AS VARCHAR)"),
        _tagged("amount_tolerance", RULE_AMOUNT, TYPE_AMOUNT),
        _tagged("date_tolerance", RULE_DATE, TYPE_DATE),
        _tagged("status_ignore", RULE_STATUS, TYPE_STATUS),
        _tagged("reference_id_match", "p.reference_id = s.reference_id",
                "CAST(NULL AS VARCHAR)")]),
    "feed_core": f"WITH {CORE} SELECT {TX} FROM core",
    "feed_card": f"{PAIR} SELECT {TX} FROM card",
    "feed_gateway": f"{PAIR_GATE} SELECT {TX} FROM gate",
    "feed_card_raw": f"{PAIR} SELECT {RAW_CARD_COLUMNS} FROM card",
    "feed_gateway_raw": f"{PAIR_GATE} SELECT {RAW_GATE_COLUMNS} FROM gate",
    "feed_telegrams": f"{TELE} SELECT {TELE_COLUMNS} FROM tele",
    "scan_range": f"""{FEEDS} SELECT {TX} FROM tx WHERE source_system = 'card_processor'
        AND transaction_date BETWEEN {LO} AND {HI}""",
    "multi_source_scan": f"""{FEEDS} SELECT {TX} FROM tx
        WHERE source_system IN ('core_banking', 'card_processor')
        AND transaction_date BETWEEN {LO} AND {HI}""",
    "standardized": f"""{RAW} SELECT transaction_id, source_system, transaction_date, amount,
        account_id, transaction_type, reference_id, {STANDARD_STATUS} AS status, payload,
        transaction_date AS created_at, processing_timestamp FROM raw""",
    "normalized": f"""{RAW} SELECT transaction_id, source_system, {SOURCE_STATUS} AS status,
        {SOURCE_TYPE} AS transaction_type FROM raw""",
    "enriched": f"WITH {CORE} SELECT {TX}, {ENRICHED} FROM core",
    "prepared": f"""{RAW} SELECT transaction_id, source_system, transaction_date, amount,
        account_id, {SOURCE_TYPE} AS transaction_type, reference_id, {SOURCE_STATUS} AS status,
        payload, created_at, processing_timestamp, {ENRICHED} FROM raw""",
    "tx_json": TX_JSON,
    "tx_json_decoded": f"WITH {CORE} SELECT {TX} FROM core",
    "summary": f"{STAR} SELECT batch_id, match_status, {TOTALS} FROM results GROUP BY 1, 2",
    "batch_report": f"""{STAR},{BATCHES}, stats AS (
        SELECT batch_id, count(*) AS total_transactions,
          count(*) FILTER (match_status = 'MATCHED') AS matched_count,
          count(*) FILTER (match_status = 'PARTIAL') AS partial_count,
          count(*) FILTER (match_status = 'UNMATCHED') AS unmatched_count,
          CAST(sum(coalesce(discrepancy_amount, 0)) AS DECIMAL(28,2)) AS total_discrepancy_amount
        FROM results GROUP BY 1)
        SELECT b.batch_id, b.status, b.reconciliation_date, s.* EXCLUDE (batch_id)
        FROM batches b LEFT JOIN stats s ON b.batch_id = s.batch_id""",
    "ts_day": _series("CAST(reconciliation_timestamp AS DATE)"),
    "ts_week": _series("CAST(date_trunc('week', reconciliation_timestamp) AS TIMESTAMP)"),
    "ts_month": _series("CAST(date_trunc('month', reconciliation_timestamp) AS TIMESTAMP)"),
    "source_report": f"""{STAR},{BATCHES} SELECT source_system, match_status, {TOTALS} FROM (
        SELECT r.*, unnest(string_split(b.source_systems, ',')) AS source_system
        FROM results r JOIN batches b ON r.batch_id = b.batch_id) GROUP BY 1, 2""",
    "discrepancies": f"""{STAR} SELECT {DISC_COLUMNS} FROM results
        WHERE match_status IN ('PARTIAL', 'UNMATCHED')""",
    "match_rate": f"""{STAR} SELECT round(coalesce(avg(
        CASE WHEN match_status = 'MATCHED' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 0), 6)
        AS match_rate FROM results""",
    "match_rate_pct": f"""{STAR} SELECT round(coalesce(avg(CASE WHEN match_status IN
        ('MATCHED', 'PARTIAL') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 0) * 100, 6)
        AS match_rate FROM results""",
    "batch_totals": f"""{STAR} SELECT batch_id,
        count(*) FILTER (match_status IN ('MATCHED', 'PARTIAL')) AS matched_count,
        count(*) FILTER (match_status = 'UNMATCHED') AS unmatched_count,
        count(*) AS total_transactions FROM results GROUP BY 1""",
    "page_batches": f"""WITH {CORE},{BATCHES} SELECT * FROM batches WHERE status = 'COMPLETED'
        ORDER BY reconciliation_date DESC, batch_id LIMIT 10 OFFSET 5""",
    "page_results": f"""{STAR} SELECT {DISC_COLUMNS} FROM results
        WHERE batch_id = 'CARD-1997-03' AND match_status = 'UNMATCHED'
        ORDER BY reconciliation_timestamp DESC, reconciliation_id LIMIT 100""",
    "page_transactions": f"""{FEEDS} SELECT {TX} FROM tx WHERE source_system = 'card_processor'
        AND transaction_date BETWEEN {LO} AND {HI}
        ORDER BY transaction_date DESC, transaction_id LIMIT 100 OFFSET 20""",
    "batch_summary": f"""{STAR},{BATCHES} SELECT b.*, round(coalesce((SELECT avg(
        CASE WHEN match_status = 'MATCHED' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
        FROM results WHERE batch_id = 'CARD-1997-03'), 0), 6) AS match_rate
        FROM batches b WHERE batch_id = 'CARD-1997-03'""",
    "incremental_new": f"""{FEEDS} SELECT {TX} FROM card n WHERE NOT EXISTS (
        SELECT 1 FROM tx e WHERE e.source_system = 'card_processor'
        AND e.transaction_date < {CUT} AND e.transaction_id = n.transaction_id)""",
    "category_update": f"""{FEEDS} SELECT transaction_id, source_system, transaction_type,
        CASE WHEN source_system = 'core_banking' THEN {CATEGORY} END AS transaction_category
        FROM tx""",
    "merge_status": f"""{FEEDS} SELECT transaction_id, source_system,
        CASE WHEN max(CASE WHEN status = 'pending' AND source_system = 'core_banking' THEN 1 ELSE 0
          END) OVER (PARTITION BY transaction_id) = 1 THEN 'completed' ELSE status END AS status,
        amount FROM tx""",
    "replace_batch_row": f"""WITH {CORE},{BATCHES} SELECT * FROM batches
        WHERE batch_id <> 'CARD-1997-03' UNION ALL
        SELECT batch_id, reconciliation_date, source_systems, start_date, end_date, 'COMPLETED',
        150, 120, 30, created_at, {AS_OF} FROM batches WHERE batch_id = 'CARD-1997-03'""",
    "as_of": f"""{HIST} SELECT transaction_id, account_id, amount, status
        FROM ({_newest(f'commit_ts <= {AS_OF}')}) WHERE op <> 'd'""",
    "commit_log": f"""{HIST} SELECT commit_ts, count(*) FILTER (op = 'c') AS inserted,
        count(*) FILTER (op = 'u') AS updated, count(*) FILTER (op = 'd') AS deleted
        FROM history GROUP BY 1""",
    "last_commits": f"""{HIST} SELECT commit_ts, count(*) FILTER (op = 'c') AS inserted,
        count(*) FILTER (op = 'u') AS updated, count(*) FILTER (op = 'd') AS deleted
        FROM history GROUP BY 1 ORDER BY 1 DESC LIMIT 5""",
    "retained_versions": f"""{HIST} {_newest(f'commit_ts <= {AS_OF}')} UNION ALL
        SELECT {HISTORY_COLUMNS} FROM history WHERE commit_ts > {AS_OF}""",
    "changes_between": f"""{HIST} SELECT {HISTORY_COLUMNS} FROM history
        WHERE commit_ts > {LO} AND commit_ts <= {HI}""",
    "created_after": f"{FEEDS} SELECT {TX} FROM tx WHERE created_at > {CUT}",
    "per_source":
        f"{FEEDS} SELECT source_system, count(*) AS transaction_count FROM tx GROUP BY 1",
    "per_day_source": f"""{FEEDS} SELECT CAST(date_trunc('day', transaction_date) AS TIMESTAMP)
        AS day, source_system, count(*) AS count FROM tx GROUP BY 1, 2""",
    "per_type": f"""{FEEDS} SELECT transaction_type, count(*) AS count FROM tx
        WHERE source_system = 'core_banking' GROUP BY 1""",
    "type_category": f"""{FEEDS} SELECT transaction_type, {CATEGORY} AS transaction_category,
        count(*) AS count FROM tx WHERE source_system = 'core_banking' GROUP BY 1, 2""",
    "row_counts": f"""WITH {CORE},{CARD},{GATE},{ALL},{TELEGRAMS},{HISTORY}
        SELECT 'source_transactions' AS table_name, count(*) AS rows FROM tx
        UNION ALL SELECT 'telegrams', count(*) FROM tele
        UNION ALL SELECT 'history', count(*) FROM history""",
    "distinct_sources": f"{FEEDS} SELECT DISTINCT source_system FROM tx",
    "feed_profile": f"""{FEEDS} SELECT source_system, count(*) AS row_count,
        min(transaction_date) AS first_date, max(transaction_date) AS last_date,
        min(amount) AS min_amount, max(amount) AS max_amount FROM tx GROUP BY 1""",
    "per_month": f"""{TELE} SELECT CAST(year(DateIn) AS INTEGER) AS year,
        CAST(month(DateIn) AS INTEGER) AS month, count(*) AS count FROM tele GROUP BY 1, 2""",
    "month_rows": f"""{TELE} SELECT {TELE_COLUMNS} FROM tele
        WHERE month(DateIn) = 1 AND year(DateIn) = 2024""",
    "minutes_fractional": f"""{TELE} SELECT round(avg({MINUTES}), 6) AS avg_min,
        round(min({MINUTES}), 6) AS min_min, round(max({MINUTES}), 6) AS max_min
        FROM tele WHERE {HANDLED}""",
    "minutes_whole": f"""{TELE} SELECT round(avg({WHOLE}), 6) AS avg_min,
        min({WHOLE}) AS min_min, max({WHOLE}) AS max_min FROM tele WHERE {HANDLED}""",
    "minutes_per_source": f"""{TELE} SELECT Source, round(avg({MINUTES}), 2) AS avg_min,
        round(min({MINUTES}), 2) AS min_min, round(max({MINUTES}), 2) AS max_min,
        count(*) AS count FROM tele WHERE {HANDLED} GROUP BY 1""",
    "period_counts": f"""{TELE} SELECT strftime(DateIn, '%Y-%m') AS period, count(*) AS count
        FROM tele GROUP BY 1""",
    "top_sources": f"""{TELE} SELECT Source, count(*) AS count FROM tele GROUP BY 1
        ORDER BY count DESC, Source LIMIT 5""",
    "busiest_hour": f"""{TELE} SELECT CAST(hour(DateIn) AS INTEGER) AS hour, count(*) AS count
        FROM tele GROUP BY 1 ORDER BY count DESC, hour LIMIT 1""",
    "latest": f"""{TELE} SELECT Id, DateIn, Source, Destination,
        round({MINUTES}, 2) AS ProcessingTime FROM tele WHERE {HANDLED}
        ORDER BY DateIn DESC, Id LIMIT 10""",
    "cdc_decoded": CDC_DECODED,
    "cdc_rejected": CDC_REJECTED,
    "cdc_latest": f"""{CDC} SELECT {TELE_COLUMNS} FROM images
        WHERE Id % 50 NOT IN (3, 9) UNION ALL SELECT {MOVED} FROM images WHERE Id % 50 = 3""",
    "cdc_stream": CDC_DECODED,
    "cdc_stream_rejected": CDC_REJECTED,
    "granted_rows": f"""{TELE} SELECT {TELE_COLUMNS} FROM tele WHERE Source IN (
        SELECT c_custkey % 9 FROM customer WHERE c_nationkey = 7
        AND TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INTEGER))
            > TIMESTAMP '2024-02-05')""",
}

SQL |= {
    "sample_rows": f"{TELE} SELECT {TELE_COLUMNS} FROM tele ORDER BY Id LIMIT 5",
    "month_orders": f"""WITH {CORE} SELECT transaction_id, transaction_date AS DateIn FROM core
        WHERE month(transaction_date) = 3 AND year(transaction_date) = 1997""",
    "csv_read": f"WITH {CORE} SELECT {TX} FROM core",
    "csv_inferred": f"""WITH {CORE} SELECT transaction_id, transaction_date, amount, status
        FROM core""",
    "csv_directory": f"{PAIR} SELECT {TX} FROM card",
    "store_table": f"""{TELE}, twice AS (SELECT * FROM tele UNION ALL SELECT * FROM tele)
        SELECT {TELE_COLUMNS}, strftime(DateIn, '%Y-%m') AS month_in FROM twice""",
    "saved_results": f"""{RECON} SELECT reconciliation_id, match_status, notes FROM h_results
        WHERE match_status = 'UNMATCHED' ORDER BY reconciliation_id LIMIT 200""",
    "granted_columns": f"{TELE} SELECT Id, DateIn FROM tele",
    "page_after": f"""{FEEDS} SELECT {TX} FROM tx WHERE source_system = 'card_processor'
        AND (transaction_date < TIMESTAMP '1997-03-01 00:00:00'
             OR transaction_date = TIMESTAMP '1997-03-01 00:00:00' AND transaction_id > 'CP-1')
        ORDER BY transaction_date DESC, transaction_id LIMIT 100""",
}

_MONTHS = f"""{TELE}, months AS (SELECT * REPLACE (DateIn + to_months(Id % 6) AS DateIn,
  DateOut + to_months(Id % 6) AS DateOut) FROM tele)"""


def _good(name: str) -> str:
    k = "CAST(regexp_extract(transaction_id, '[0-9]+') AS BIGINT)"
    return f"SELECT {TX} FROM {name} WHERE {k} % 79 <> 0 AND {k} % 83 <> 0 AND {k} % 97 <> 0 AND {k} % 89 <> 0"


SQL |= {
    "cdc_stream_latest": SQL["cdc_latest"],
    "cdc_stream_once": CDC_DECODED,
    "as_of_months": f"""{HIST}, moments AS (
          SELECT unnest(range(TIMESTAMP '1993-01-01', TIMESTAMP '1999-01-01', INTERVAL 3 MONTH))
            AS moment),
        versions AS (SELECT moment, h.*, row_number() OVER (PARTITION BY moment, transaction_id
            ORDER BY commit_ts DESC, seq DESC) AS age
          FROM moments JOIN history h ON commit_ts <= moment)
        SELECT moment, status, count(*) AS count, CAST(sum(amount) AS DECIMAL(28,2)) AS amount
        FROM versions WHERE age = 1 AND op <> 'd' GROUP BY 1, 2""",
    "store_merged": f"""{_MONTHS} SELECT Id, TelegramCode, Source,
        CASE WHEN strftime(DateIn, '%Y-%m') = '2024-03' AND TelegramCode % 3 = 0 THEN 9
             ELSE Destination END AS Destination, DateIn, DateOut, Body FROM months""",
    "month_rows_stored": f"""{_MONTHS} SELECT {TELE_COLUMNS} FROM months
        WHERE year(DateIn) = 2024 AND month(DateIn) = 3""",
    "period_counts_months": f"""{_MONTHS} SELECT strftime(DateIn, '%Y-%m') AS period,
        count(*) AS count FROM months GROUP BY 1""",
    "telegram_summary": f"""{_MONTHS}, keyed AS (SELECT CAST(year(DateIn) AS INTEGER) AS year,
          CAST(month(DateIn) AS INTEGER) AS month, Source, CAST(hour(DateIn) AS INTEGER) AS hour,
          CASE WHEN {HANDLED} THEN {MINUTES} END AS minutes FROM months)
        SELECT CASE WHEN grouping(year) = 0 THEN 'month' WHEN grouping(Source) = 0 THEN 'source'
            WHEN grouping(hour) = 0 THEN 'hour' ELSE 'total' END AS part,
          year, month, Source, hour, count(*) AS count, count(minutes) AS handled,
          round(avg(minutes), 6) AS avg_min, round(min(minutes), 6) AS min_min,
          round(max(minutes), 6) AS max_min
        FROM keyed GROUP BY GROUPING SETS ((), (year, month), (Source), (hour))""",
    "csv_good": f"WITH {CORE} {_good('core')}",
    "csv_new_files": f"{PAIR} {_good('core')} UNION ALL {_good('card')}",
    "csv_rejected": f"""WITH {CORE}, keyed AS (
          SELECT transaction_id AS id, CAST(substr(transaction_id, 4) AS BIGINT) AS k FROM core)
        SELECT CASE WHEN k % 79 = 0 THEN 'malformed line' WHEN k % 83 = 0 THEN 'no id'
            WHEN k % 97 = 0 THEN 'unreadable amount' ELSE 'unreadable transaction_date' END
            AS reason, CASE WHEN k % 83 = 0 THEN '' ELSE id END AS transaction_id
        FROM keyed WHERE k % 79 = 0 OR k % 83 = 0 OR k % 97 = 0 OR k % 89 = 0""",
    "payload_categories": f"""{FEEDS} SELECT transaction_type,
        json_extract_string(payload, '$.category') AS category, count(*) AS count
        FROM tx GROUP BY 1, 2""",
}

# The skewed feeds differ in the account alone.
_FEW = "'ACC' || CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 20 END"
SQL |= {f"{name}_skewed": SQL[query].replace("'ACC' || o_custkey", _FEW) for name, query in (
    ("hybrid_match", "hybrid_match"), ("fuzzy_best", "fuzzy_best"),
    ("greedy", "greedy_one_to_one"), ("rule_amount", "rule_amount"), ("rule_date", "rule_date"))}
