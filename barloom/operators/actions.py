"""Corporate actions: candidates, review, and prices adjusted backwards for splits and dividends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.keys import deterministic_uuid
from barloom.functions.values import canonical_json, dividend_factor, quantize, sha256, split_factors
from barloom.operators.merge import asof_before
from barloom.sources.shared import written

_WIDE = "decimal(28,18)"


def explode_pages(pages: DataFrame, column: str = "page") -> DataFrame:
    """Provider pages of corporate actions (JSON) as rows: ticker, event_type, effective_date, terms, source_id.

    A split's ratio is reduced to lowest terms. An unknown collection raises an error."""
    dividend = "array<struct<id:string,initiating_symbol:string,symbol:string,target_symbol:string,ex_date:date,cash:decimal(28,8),currency:string>>"
    split = "array<struct<id:string,initiating_symbol:string,symbol:string,target_symbol:string,ex_date:date,old_rate:bigint,new_rate:bigint>>"
    inner = F.get_json_object(F.col(column), "$.corporate_actions")
    known = F.array(*[F.lit(x) for x in ("cash_dividends", "forward_splits", "reverse_splits")])
    strange = F.array_except(F.json_object_keys(inner), known)
    checked = F.when(F.size(strange) > 0, F.raise_error(F.concat(F.lit("unknown collection: "), F.array_join(strange, ",")))).otherwise(inner)
    doc = pages.select(F.from_json(checked, f"cash_dividends {dividend}, forward_splits {split}, reverse_splits {split}").alias("d"))
    ticker = F.coalesce("x.initiating_symbol", "x.symbol", "x.target_symbol")
    base = [ticker.alias("ticker"), F.col("x.ex_date").alias("effective_date"), F.col("x.id").alias("source_id")]
    d = doc.select(F.explode("d.cash_dividends").alias("x")).select(*base, F.lit("CASH_DIVIDEND").alias("event_type"), canonical_json(amount=F.col("x.cash").cast("string"), currency=F.coalesce("x.currency", F.lit("USD"))).alias("terms"))
    both = F.concat(F.coalesce("d.forward_splits", F.array().cast(split)), F.coalesce("d.reverse_splits", F.array().cast(split)))
    s = doc.select(F.explode(both).alias("x")).select(*base, F.col("x.old_rate").alias("a"), F.col("x.new_rate").alias("b"))
    # Euclid's steps for 64-bit numbers: at most 92, each a fold over a fixed sequence.
    gcd = F.aggregate(F.sequence(F.lit(1), F.lit(92)), F.struct(F.col("a"), F.col("b")), lambda acc, _: F.when(acc["b"] == 0, acc).otherwise(F.struct(acc["b"].alias("a"), F.try_mod(acc["a"], acc["b"]).alias("b"))), lambda acc: acc["a"])
    s = s.withColumn("g", gcd)
    terms = canonical_json(from_shares=F.expr("a div g").cast("string"), to_shares=F.expr("b div g").cast("string"))
    return d.unionByName(s.select("ticker", "effective_date", "source_id", F.lit("SPLIT").alias("event_type"), terms.alias("terms")))


def dedup_conflicts(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row of each action, keys with different terms): equal terms of one key collapse."""
    key = ["ticker", "event_type", "effective_date", "source_id"]
    g = actions.groupBy(*key).agg(F.countDistinct("terms").alias("n"), F.min("terms").alias("terms"))
    return g.where("n = 1").drop("n"), g.where("n > 1").select(*key, F.col("n").alias("versions"))


def event_key(source_id: Column, event_type: Column, ticker: Column, day: Column) -> Column:
    return F.concat_ws(":", source_id, event_type, ticker, day.cast("string"))


def candidates(actions: DataFrame) -> DataFrame:
    """Actions as candidate rows: an id from the natural key, the key and a digest of what was found (not of who found it)."""
    digest = sha256(canonical_json(ticker=F.col("ticker"), event_type=F.col("event_type"), effective_date=F.col("effective_date").cast("string"), terms=F.col("terms")))
    key = event_key(F.col("source_id"), F.col("event_type"), F.col("ticker"), F.col("effective_date"))
    return actions.withColumn("provider_event_key", key).withColumn("terms_hash", digest).withColumn("id", deterministic_uuid(F.lit("corporate-action"), "provider_event_key"))


def confidence(claims: DataFrame, material: list[str]) -> DataFrame:
    """For each candidate the least confidence of its claims, four places, and the material fields that no claim backs.

    claims: candidate_id, field, confidence, cited (whether its evidence is cited), agrees (whether the value is equal)."""
    backed = F.collect_set(F.when(F.col("cited") & F.col("agrees"), F.col("field")))
    need = F.array(*[F.lit(x) for x in material])
    out = claims.groupBy("candidate_id").agg(F.min("confidence").alias("_min"), backed.alias("_backed"))
    return out.select("candidate_id", F.bround(F.col("_min").cast("decimal(10,8)"), 4).alias("confidence"), F.array_sort(F.array_except(need, F.col("_backed"))).alias("unclaimed"))


# What a decision does to a candidate's state; anything else is refused. No state comes back, so a candidate moves at most
# as often as there are rows of moves.
_MOVES = [{("REVIEW_REQUIRED", "APPROVE"): "APPROVED", ("REVIEW_REQUIRED", "REJECT"): "REJECTED"}, {("APPROVED", "WITHDRAW"): "WITHDRAWN", ("APPROVED", "SUPERSEDE"): "SUPERSEDED"}]


def review_fold(decisions: DataFrame) -> DataFrame:
    """Decision events of each candidate, in order of their sequence, folded to its last state and its refusals.

    decisions: candidate_id, aggregate_sequence, decision, content_hash, expected_hash, delivery_id. A decision on other
    content is STALE_CONTENT_HASH; the same sequence again with another delivery DELIVERY_ID_CONFLICT (with the same one it
    is a repeat and does nothing); withdrawing what is not approved WITHDRAWAL_STATE_CONFLICT; superseding what is not
    approved SUPERSEDED_CANDIDATE_NOT_APPROVED; deciding anew what is decided CONFLICTING_REDECISION.

    States only move forward, so each move is the first event that makes it after the move before: one aggregate a move, and
    all other events are judged by themselves. Only the refusals of a candidate are put in order, for its text.
    """
    w = Window.partitionBy("candidate_id", "aggregate_sequence").orderBy("delivery_id", "decision", "fresh")
    e = decisions.withColumn("fresh", F.col("content_hash") == F.col("expected_hash")).select("candidate_id", "aggregate_sequence", "decision", "fresh", "delivery_id")
    again = (F.col("_n") > 1) | F.col("aggregate_sequence").isNull()
    e = e.withColumns({"_n": F.row_number().over(w), "_before": F.lag("delivery_id").over(w)}).withColumn("_again", again)
    e = written(e.withColumn("_repeat", F.coalesce(F.col("_again") & (F.col("_before") == F.col("delivery_id")), F.lit(False))).drop("_before", "delivery_id"), "decisions")
    counts = ~F.col("_again") & F.coalesce("fresh", F.lit(True))

    states = e.select(F.col("candidate_id").alias("_id")).distinct().withColumns({"state": F.lit("REVIEW_REQUIRED"), "_moves": F.array().cast("array<bigint>")})
    same = F.col("candidate_id").eqNullSafe(F.col("_id"))
    for moves in _MOVES:
        to = F.coalesce(*[F.when((F.col("state") == a) & (F.col("decision") == d), F.lit(to)) for (a, d), to in moves.items()])
        after = F.coalesce(F.col("aggregate_sequence") > F.try_element_at("_moves", F.lit(-1)), F.lit(True)) if moves is not _MOVES[0] else F.lit(True)
        first = e.where(counts).join(states, same).withColumn("_to", to).where(F.col("_to").isNotNull() & after)
        first = first.groupBy("candidate_id").agg(F.min("aggregate_sequence").alias("_at"), F.min_by("_to", "aggregate_sequence").alias("_to"))
        j = states.join(first, same, "left")
        states = j.select("_id", F.coalesce("_to", "state").alias("state"), F.when(F.col("_at").isNotNull(), F.array_append("_moves", F.col("_at"))).otherwise(F.col("_moves")).alias("_moves"))

    refusal = (
        F.when(F.col("_repeat"), F.lit(None))
        .when(F.col("_again"), "DELIVERY_ID_CONFLICT")
        .when(~F.col("fresh"), "STALE_CONTENT_HASH")
        .when(F.array_contains("_moves", F.col("aggregate_sequence")), F.lit(None))
        .when(F.col("decision") == "WITHDRAW", "WITHDRAWAL_STATE_CONFLICT")
        .when(F.col("decision") == "SUPERSEDE", "SUPERSEDED_CANDIDATE_NOT_APPROVED")
        .otherwise("CONFLICTING_REDECISION")
    )
    states = written(states, "states")
    refused = e.join(states, same).withColumn("_why", refusal).where("_why IS NOT NULL")
    text = F.struct("aggregate_sequence", "_n", F.concat_ws(":", F.col("aggregate_sequence").cast("string"), "_why").alias("text"))
    log = refused.groupBy("candidate_id").agg(F.array_sort(F.collect_list(text))["text"].alias("_log"))
    out = states.join(log, same, "left")
    return out.select(F.col("_id").alias("candidate_id"), "state", F.coalesce(F.array_join("_log", ","), F.lit("")).alias("refusals"))


def factors(actions: DataFrame, raw_bars: DataFrame) -> DataFrame:
    """Approved actions with a price and a volume factor, eight places each.

    actions: instrument_id, effective_at, action_type, from_shares, to_shares, amount. A dividend's factor uses the raw
    close of the last bar strictly before it takes effect; one that is not less than that close raises an error."""
    a = asof_before(actions, raw_bars, "instrument_id", "effective_at", "bar_start_at", "close", "close_before")
    price, volume = split_factors(F.col("from_shares"), F.col("to_shares"))
    paid = dividend_factor(F.col("close_before"), F.col("amount"))
    refused = F.raise_error(F.lit("a dividend is not less than the close before it"))
    one = F.lit(1).cast("decimal(38,8)")
    split = F.col("action_type") == "SPLIT"
    dividend = F.when(F.col("close_before").isNull(), one).otherwise(F.coalesce(paid, refused.cast("decimal(38,8)")))
    return a.withColumn("price_factor", F.when(split, price).otherwise(dividend)).withColumn("volume_factor", F.when(split, volume).otherwise(one))


def adjust_bars(raw: DataFrame, actions: DataFrame) -> DataFrame:
    """Bars with prices and vwap times the factors of all later actions, eight places, and volume to a whole number.

    Factors of an instrument are one short array beside its bars, joined by instrument: bars are not multiplied."""
    f = factors(actions, raw).groupBy("instrument_id").agg(F.array_sort(F.collect_list(F.struct("effective_at", "price_factor", "volume_factor"))).alias("_f"))
    b = raw.join(f, "instrument_id", "left").withColumn("_f", F.filter(F.coalesce("_f", F.array().cast(f.schema["_f"].dataType)), lambda x: x["effective_at"] > F.col("bar_start_at")))
    product = lambda c: F.aggregate("_f", F.lit(1).cast(_WIDE), lambda acc, x: (acc.cast("decimal(20,16)") * x[c].cast("decimal(16,8)")).cast(_WIDE))
    b = b.withColumn("_p", product("price_factor")).withColumn("_v", product("volume_factor"))
    scaled = lambda c: quantize((F.col(c).cast("decimal(18,8)") * F.col("_p").cast("decimal(19,16)")).cast("decimal(38,18)"))
    prices = {c: scaled(c).alias(c) for c in ("open", "high", "low", "close", "vwap")}
    volume = F.bround((F.col("volume").cast("decimal(18,0)") * F.col("_v").cast("decimal(19,16)")).cast("decimal(38,16)"), 0).cast("bigint")
    return b.select(*[prices.get(c, volume.alias(c) if c == "volume" else F.col(c)) for c in raw.columns])
