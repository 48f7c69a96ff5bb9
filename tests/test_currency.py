"""As-of quotes and conversions against plain loops."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tallyforge.operators.currency import as_of, convert

START = datetime(2024, 1, 1)


def tables(seed):
    draw = random.Random(seed)
    quotes = [(c, START + timedelta(minutes=draw.randrange(200_000)), Decimal(draw.randrange(1, 10**8)) / 10**6) for c in ("EUR", "TRY") for _ in range(60)]
    quotes += [("GBP", START + timedelta(days=100), Decimal("1.25")), (None, START, Decimal(1)), ("EUR", None, Decimal(9))]
    rows = [(f"i{i}", draw.choice(["EUR", "TRY", "GBP", "USD", "XXX"]), START + timedelta(minutes=draw.randrange(250_000)), Decimal(draw.randrange(10**7)) / 100) for i in range(300)]
    rows += [(f"at{i}", c, at, Decimal("10.00")) for i, (c, at, _) in enumerate(quotes[:6])]  # the very moment of a quote
    rows += [("none", None, START, Decimal(1)), ("never", "EUR", None, Decimal(1)), ("early", "EUR", START - timedelta(days=400), Decimal(1))]
    return quotes, rows


def held(quotes, currency, moment):
    if moment is None:
        return None
    fit = [(at, rate) for c, at, rate in quotes if c is not None and c == currency and at is not None and at <= moment]
    return max(fit, default=None)


@pytest.mark.parametrize("span", [3600, 86400 * 7, 86400 * 4000])
def test_as_of_against_a_loop(spark, span):
    quotes, rows = tables(span)
    q = spark.createDataFrame(quotes, "currency string, quoted_at timestamp, rate decimal(18,8)").repartition(3)
    r = spark.createDataFrame(rows, "invoice string, currency string, moment timestamp, total decimal(18,2)").repartition(4)
    got = {x.invoice: (x.quoted_at, x.rate) for x in as_of(r, q, ["currency"], "moment", "quoted_at", span).collect()}
    assert len(got) == len(rows)
    assert got == {i: held(quotes, c, at) or (None, None) for i, c, at, _ in rows}
    assert as_of(r.limit(0), q, ["currency"], "moment", "quoted_at").count() == 0


@pytest.mark.parametrize("to", ["USD", "TRY"])
def test_conversion_goes_through_the_base(spark, to):
    quotes, rows = tables(5)
    q = spark.createDataFrame(quotes, "currency string, quoted_at timestamp, rate decimal(18,8)")
    r = spark.createDataFrame(rows, "invoice string, currency string, moment timestamp, total decimal(18,2)")
    got = {x.invoice: x for x in convert(r, q, to, "moment").collect()}
    for invoice, currency, moment, total in rows:
        own = (None, Decimal(1)) if currency == "USD" else held(quotes, currency, moment)
        target = (None, Decimal(1)) if to == "USD" else held(quotes, to, moment)
        row = got[invoice]
        if currency == to:
            assert (row.fx_rate, row.converted_amount) == (1, total)
        elif own is None or target is None:
            assert (row.fx_rate, row.quoted_at, row.converted_amount) == (None, None, None)
        else:
            rate = (own[1] / target[1]).quantize(Decimal("1e-8"), ROUND_HALF_UP)
            assert (row.fx_rate, row.converted_amount) == (rate, (total * rate).quantize(Decimal("0.01"), ROUND_HALF_UP))
            assert row.quoted_at == min(x for x in (own[0], target[0]) if x is not None)
