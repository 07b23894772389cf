import dataclasses
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import matching, pairs, results
from tallybook.operators.skew import distributed_rank
from tallybook.settings import DEFAULTS
from tests import fixtures as fx

# The search starts with the whole tolerance, with small radii, or with radii where it is crowded.
ROUTES = {
    "wide": dataclasses.replace(DEFAULTS, crowded_cell=10 ** 9),
    "radii": dataclasses.replace(DEFAULTS, crowded_cell=0),
    "default": DEFAULTS,
}


def ids(outcome):
    return sorted([(r[0], r[1]) for r in outcome.select(
        "primary_transaction_id", "secondary_transaction_id").collect()], key=str)


@pytest.fixture(scope="module")
def edge(spark):
    ps, ss = fx.edge_rows()
    return ps, ss, fx.frame(spark, ps), fx.frame(spark, ss)


@pytest.fixture(scope="module")
def crowd(spark):
    ps, ss = fx.random_rows(7, 260, 12)
    return ps, ss, fx.frame(spark, ps).cache(), fx.frame(spark, ss).cache()


@pytest.mark.parametrize("route", ["wide", "radii"])
@pytest.mark.parametrize("strategy", matching.STRATEGIES)
def test_edge_rows_against_brute_force(edge, route, strategy):
    ps, ss, p, s = edge
    found = matching.outcomes(p, s, strategy, ROUTES[route])
    assert ids(found) == fx.brute_force(ps, ss, *matching.STRATEGIES[strategy])


@pytest.mark.parametrize("strategy,route", [
    ("exact", "default"), *[(x, route) for x in ("fuzzy", "hybrid") for route in ROUTES]])
def test_crowd_against_brute_force(crowd, strategy, route):
    ps, ss, p, s = crowd
    found = matching.outcomes(p, s, strategy, ROUTES[route])
    assert ids(found) == fx.brute_force(ps, ss, *matching.STRATEGIES[strategy])


def test_each_row_is_accounted_for(crowd):
    ps, ss, p, s = crowd
    sets = matching.match_transactions(p, s, "fuzzy")
    matched = [r[0] for r in sets.matched.select("primary_transaction_id").collect()]
    alone = [r[0] for r in sets.unmatched_primary.select("transaction_id").collect()]
    assert sorted(matched + alone) == sorted(r[0] for r in ps)
    used = {r[0] for r in sets.matched.select("secondary_transaction_id").collect()}
    rest = {r[0] for r in sets.unmatched_secondary.select("transaction_id").collect()}
    assert used | rest == {r[0] for r in ss} and not used & rest


def test_classes(edge):
    _, _, p, s = edge
    rows = {(r["primary_transaction_id"], r["secondary_transaction_id"]): r
            for r in matching.outcomes(p, s).collect()}
    kind = {k: (r["match_status"], r["discrepancy_type"], r["discrepancy_amount"])
            for k, r in rows.items()}
    assert kind[("p-zero", "s-zero")] == ("PARTIAL", "STATUS", None)
    assert kind[("p-edge", "s-edge")] == ("PARTIAL", "AMOUNT", Decimal("10.00"))
    assert kind[("p-tie", "s-tie-a")] == ("PARTIAL", "STATUS", None)
    assert kind[("p-nullstatus", "s-nullstatus")] == ("PARTIAL", None, None)
    assert kind[("p-over", None)] == ("UNMATCHED", "MISSING_SECONDARY", Decimal("1000.00"))
    assert kind[(None, "s-late")] == ("UNMATCHED", "MISSING_PRIMARY", Decimal("100.50"))
    assert kind[("p-neg", None)][1] == "MISSING_SECONDARY"
    assert kind[("p-negsame", "s-negsame")] == ("MATCHED", None, None)


def test_unknown_strategy(edge):
    with pytest.raises(ValueError, match="is none of"):
        matching.match_transactions(edge[2], edge[3], "best")


@pytest.mark.parametrize("route", ROUTES)
def test_star_equals_separate_runs(spark, route):
    ps, ss = fx.random_rows(3, 80, 4)
    _, more = fx.random_rows(4, 80, 4)
    third = [(r[0].replace("s", "g"), *r[1:7], "payment_gateway") for r in more]
    both = fx.frame(spark, ps + ss + third)
    sources = ["core_banking", "card_processor", "payment_gateway"]
    found = matching.match_star(both, sources, settings=ROUTES[route])
    for source, rows in (("card_processor", ss), ("payment_gateway", third)):
        mine = found.filter(F.col("secondary_source") == source)
        assert ids(mine) == fx.brute_force(ps, rows, True, True)
    with pytest.raises(ValueError, match="at least one other"):
        matching.match_star(both, sources[:1])


def test_exact_pairs_and_unmatched_rows(crowd):
    ps, ss, p, s = crowd
    expected = sorted((a[0], b[0]) for a in ps for b in ss if fx.same_key(a, b))
    assert ids(pairs.exact_pairs(p, s)) == expected
    hit = {a for a, _ in expected}
    alone = pairs.unmatched_rows(p, s)
    assert alone.columns == p.columns
    assert sorted(r[0] for r in alone.select("transaction_id").collect()) == sorted(
        r[0] for r in ps if r[0] not in hit)


def test_candidates_against_brute_force(crowd):
    ps, ss, p, s = crowd
    found = pairs.fuzzy_candidates(p, s)
    assert ids(found) == sorted((a[0], b[0]) for a in ps for b in ss if fx.near(a, b))
    scores = {(r[0], r[1]): r["match_score"] for r in found.collect()}
    by_id = {r[0]: r for r in ps + ss}
    assert all(abs(v - fx.score(by_id[a], by_id[b])) < 1e-12 for (a, b), v in scores.items())


@pytest.mark.parametrize("tolerance", ["0.3", "0.7", "1.5"])
def test_other_tolerances(crowd, tolerance):
    ps, ss, p, s = crowd
    wide = Decimal(tolerance)
    found = pairs.fuzzy_candidates(p, s, wide, 0)
    expected = sorted((a[0], b[0]) for a in ps for b in ss if fx.near(a, b, wide, 0))
    assert ids(found) == expected
    for route in ("wide", "radii"):
        st = dataclasses.replace(ROUTES[route], amount_tolerance=wide, date_tolerance_seconds=0)
        best = matching.match_transactions(p, s, "fuzzy", st).matched
        assert best.count() == len({a for a, _ in expected})


@pytest.mark.parametrize("route", ROUTES)
def test_repeated_and_missing_ids(spark, route):
    """A record is its id: paired in one row, it is left over in none, whatever its group."""
    ps = [fx.row("P1", "A"), fx.row("P1", "Z"), fx.row("P2", "B", amount="50.00"),
          fx.row("P2", "B", amount="50.20"), fx.row(None, "N"), fx.row(None, "Q"),
          fx.row("P3", "C", status="failed")]
    ss = [fx.row("S1", "A"), fx.row("S1", "B", amount="7.00"), fx.row("S2", "B", amount="50.10"),
          fx.row(None, "N"), fx.row(None, "R"), fx.row("S4", "C"), fx.row("S4", "Y")]
    found = matching.outcomes(fx.frame(spark, ps), fx.frame(spark, ss), settings=ROUTES[route])
    rows = sorted(((r["primary_transaction_id"], r["secondary_transaction_id"], r["account_id"],
                    r["outcome"]) for r in found.collect()), key=str)
    assert rows == sorted([
        ("P1", "S1", "A", "PAIR"), ("P2", "S2", "B", "PAIR"), ("P3", "S4", "C", "PAIR"),
        (None, None, "N", "PAIR"), (None, None, "Q", "PRIMARY_ONLY"),
        (None, None, "R", "SECONDARY_ONLY")], key=str)


def test_left_overs_by_counted_records(spark):
    """Rows that repeat, lack an id or a key, and records of which only some rows are paired."""
    def rows(*found):
        return spark.createDataFrame(
            [(b, a, "fee", Decimal(n), "done", i, None) for b, i, a, n in found],
            "system string, account_id string, transaction_type string, amount decimal(18,2), "
            "status string, transaction_id string, transaction_date timestamp_ntz")

    mine = rows(("x", "1", "A", "1"), ("x", "1", "A", "2"), ("x", "2", "A", "2"),
                ("x", "2", "A", "2"), ("y", "1", "A", "2"), ("x", None, "A", "1"),
                ("x", None, "A", "3"), ("x", None, "A", "3"), ("x", "3", None, "1"),
                ("x", "3", "A", "1"), (None, "4", "A", "1"), ("x", "5", None, "1"))
    others = rows(("x", "9", "A", "1"), ("x", "9", "A", "1"), ("x", None, None, "1"),
                  (None, "4", "A", "1"))
    found = matching._without_exact(mine, others, ["system"]).select(
        "system", "transaction_id", "account_id", F.col("amount").cast("int")).collect()
    assert sorted(map(tuple, found), key=str) == sorted([
        ("x", "2", "A", 2), ("x", "2", "A", 2), ("y", "1", "A", 2), ("x", None, "A", 3),
        ("x", None, "A", 3), (None, "4", "A", 1), ("x", "5", None, 1)], key=str)


def test_distributed_rank(spark):
    rows = [("g" if i % 3 else "h", f"{i:05d}") for i in range(999)]
    df = spark.createDataFrame(rows, "g string, id string").repartition(7)
    found = sorted(tuple(r) for r in distributed_rank(df, ["g"], ["id"], "rank").collect())
    expected = []
    for g in "gh":
        expected += [(g, i, n) for n, i in enumerate(sorted(i for k, i in rows if k == g), 1)]
    assert found == expected


def test_results_are_repeatable_and_worded(edge):
    _, _, p, s = edge
    at = F.lit(fx.T0)

    def run():
        found = results.reconciliation_results(
            matching.outcomes(p, s), "B1", "core_banking", "card_processor", at)
        return {(r["primary_transaction_id"], r["secondary_transaction_id"]): r
                for r in found.collect()}

    first, second = run(), run()
    assert {k: r["reconciliation_id"] for k, r in first.items()} == {
        k: r["reconciliation_id"] for k, r in second.items()}
    assert len({r["reconciliation_id"] for r in first.values()}) == len(first)
    notes = {k: r["notes"] for k, r in first.items()}
    assert notes[("p-edge", "s-edge")] == (
        "Partial match between core_banking and card_processor. Amount discrepancy: 10.00")
    assert notes[("p-zero", "s-zero")] == (
        "Partial match between core_banking and card_processor. "
        "Status discrepancy: Primary=completed, Secondary=pending")
    assert notes[("p-nullstatus", "s-nullstatus")] == (
        "Partial match between core_banking and card_processor. ")
    assert notes[("p-dup1", "s-dup1")] == "Exact match between core_banking and card_processor"
    assert notes[("p-neg", None)] == "Transaction in core_banking not found in card_processor"
    assert notes[(None, "s-neg")] == "Transaction in card_processor not found in core_banking"
