"""The fold of review decisions against one event after the other, and its work where a candidate has very many events."""

import random
import time

from pyspark.sql import functions as F

from barloom.operators import actions

MOVES = {("REVIEW_REQUIRED", "APPROVE"): "APPROVED", ("REVIEW_REQUIRED", "REJECT"): "REJECTED", ("APPROVED", "WITHDRAW"): "WITHDRAWN", ("APPROVED", "SUPERSEDE"): "SUPERSEDED"}
KIND = "candidate_id string, aggregate_sequence long, decision string, content_hash string, expected_hash string, delivery_id string"


def one_by_one(rows):
    state, seq, delivery, out = "REVIEW_REQUIRED", None, None, []
    order = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
    for s, d, what, fresh in sorted(((r[1], r[5], r[2], None if r[3] is None else r[3] == r[4]) for r in rows), key=order):
        why = None
        if seq == s:
            why = None if delivery is not None and delivery == d else "DELIVERY_ID_CONFLICT"
        elif fresh is False:
            why = "STALE_CONTENT_HASH"
        elif (state, what) in MOVES:
            state = MOVES[state, what]
        else:
            why = {"WITHDRAW": "WITHDRAWAL_STATE_CONFLICT", "SUPERSEDE": "SUPERSEDED_CANDIDATE_NOT_APPROVED"}.get(what, "CONFLICTING_REDECISION")
        seq, delivery = s, d
        if why:
            out.append(why if s is None else f"{s}:{why}")
    return state, ",".join(out)


def test_fold_is_that_of_one_event_after_the_other(spark):
    rng = random.Random(5)
    pick = lambda *x: rng.choice(x)
    rows = [(pick(*"abcdefghijkl", None), pick(None, *range(12)), pick("APPROVE", "REJECT", "WITHDRAW", "SUPERSEDE", "OTHER", None), pick("x", "x", "x", "y", None), "x", pick("d1", "d2", None)) for _ in range(160)]
    rows += [("quiet", 1, "APPROVE", "x", "x", "d"), ("old", 1, "APPROVE", "y", "x", "d")]
    got = {r[0]: (r[1], r[2]) for r in actions.review_fold(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {c: one_by_one([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}


def test_work_grows_with_the_events_of_a_candidate(spark):
    d = spark.range(200_000).select(F.lit("a").alias("candidate_id"), F.col("id").alias("aggregate_sequence"), F.lit("WITHDRAW").alias("decision"), F.lit("x").alias("content_hash"), F.lit("x").alias("expected_hash"), F.lit("d").alias("delivery_id"))
    began = time.monotonic()
    (r,) = actions.review_fold(d).collect()
    assert r.state == "REVIEW_REQUIRED" and r.refusals.count(",") == 199_999 and time.monotonic() - began < 60
