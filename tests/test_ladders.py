"""Boundary values of every scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vendaval.functions import ladders
from vendaval.functions import scalars as S
from vendaval.functions.fixed import REGION_STATES, TIER_STATES


def labels(spark, kind, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(("fn", "kind", "cases"), [
    (ladders.delay_scale, "int", {
        -4: "muito_adiantado", -3: "muito_adiantado", -2: "no_prazo", 0: "no_prazo", 1: "atraso_leve",
        5: "atraso_leve", 6: "atraso_grave", None: "sem_informacao",
    }),
    (ladders.size_class, "int", {500: "pequeno", 501: "medio", 5000: "medio", 5001: "grande", None: "grande"}),
    (ladders.score_sentiment, "int", {
        0: "negativo", 1: "negativo", 2: "negativo", 3: "neutro", 4: "positivo", 5: "positivo", None: "negativo",
    }),
    (ladders.staleness, "int", {
        30: "Ativo", 31: "Moderado", 90: "Moderado", 91: "Baixo", 180: "Baixo", 181: "Inativo",
    }),
    (ladders.seller_tier, "double", {
        80.0: "Excelente", 79.99: "Bom", 60.0: "Bom", 59.99: "Regular", 40.0: "Regular", 39.99: "Critico",
    }),
    (ladders.risk_band, "double", {
        0.0: "baixo", 0.3: "baixo", 0.30001: "medio", 0.6: "medio", 0.60001: "alto", 1.0: "alto", None: None,
    }),
    (ladders.season, "int", {1: "Alta", 2: "Alta", 3: "Media", 4: "Media", 5: "Baixa", 8: "Baixa", 9: "Media", 11: "Alta"}),
    (ladders.payment_group, "string", {
        "credit_card": "cartao", "debit_card": "cartao", "boleto": "boleto", "voucher": "voucher", "x": "outro",
        None: "outro",
    }),
])
def test_boundaries(spark, fn, kind, cases):
    assert labels(spark, kind, list(cases), fn) == list(cases.values())


def test_every_state_has_one_region(spark):
    states = [s for group in REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27
    assert "Outros" not in labels(spark, "string", states, ladders.region)
    assert labels(spark, "string", ["XX", None], ladders.region) == ["Outros", "Outros"]
    assert labels(spark, "string", [TIER_STATES["Tier 2"][0], "AC"], ladders.market_tier) == ["Tier 2", "Tier 3"]


@pytest.mark.parametrize(("frequency", "recency", "segment"), [
    (3, 90, "Champions"), (3, 91, "Loyal"), (2, 90, "Loyal"), (2, 180, "Loyal"), (2, 181, "At Risk"), (9, 999, "At Risk"),
    (1, 90, "New"), (1, 91, "Hibernating"), (1, 365, "Hibernating"), (1, 366, "Lost"), (2, None, "Hibernating"),
])
def test_rfm_segment(frame, frequency, recency, segment):
    df = frame("f int, r int", (frequency, recency))
    assert df.select(ladders.rfm_segment(F.col("f"), F.col("r"))).first()[0] == segment


def test_delivery_status(frame, at):
    day, later = at("2020-01-01"), at("2020-01-02")
    df = frame("i int, d timestamp, e timestamp", (0, day, day), (1, later, day), (2, None, day), (3, day, None))
    status = ladders.delivery_status(F.col("d"), F.col("e"))
    assert [r[0] for r in df.orderBy("i").select(status).collect()] == ["no_prazo", "atrasado", "pendente", "pendente"]


def test_text_helpers(frame):
    df = frame("zip int, city string, code string", (1001, " São Paulo ", "a_b_c"), (123456, None, None), (None, "", "x"))
    got = df.select(
        S.pad_zip("zip", keep_longer=True), S.clean_lower("city"), S.underscores_to_spaces("code"), S.has_text("city"), S.longer_than("city", 0)
    ).collect()
    assert tuple(got[0]) == ("01001", "são paulo", "a b c", True, True)
    assert tuple(got[1]) == ("123456", None, None, False, False)
    assert tuple(got[2]) == (None, "", "x", False, False)


def test_postal_prefix_of_four_five_six_digits(frame):
    df = frame("i int, zip string", (0, "1234"), (1, "12345"), (2, "123456"), (3, None), (4, ""))
    got = [tuple(r) for r in df.orderBy("i").select(S.pad_zip("zip"), S.pad_zip("zip", keep_longer=True)).collect()]
    assert got == [("01234", "01234"), ("12345", "12345"), ("12345", "123456"), (None, None), ("00000", "00000")]


def test_bad_input_gives_null_not_an_error(frame):
    df = frame("ts string, m string, n int", ("2020-13-45", "abc", 0))
    got = df.select(S.to_ts("ts"), S.money("m"), S.percent(F.lit(1), F.col("n")), S.ratio(F.lit(1), F.col("n"), 2)).first()
    assert tuple(got) == (None, None, None, None)


def test_means_round_half_up_once(frame):
    df = frame("v decimal(10,2)", *[(x,) for x in map(__import__("decimal").Decimal, ("0.01", "0.02"))])
    assert str(df.agg(S.mean_of("v", 2)).first()[0]) == "0.02"
    assert str(df.agg(S.mean_of(-F.col("v"), 2)).first()[0]) == "-0.02"


def test_array_total_null_element(frame):
    df = frame("p array<struct<value:double>>", ([(1.0,), (None,)],), ([],))
    got = df.select(S.array_total("p", lambda p: p["value"]), S.array_total("p", lambda p: p["value"], skip_nulls=True)).collect()
    assert tuple(got[0]) == (None, 1.0)
    assert tuple(got[1]) == (0.0, 0.0)


def test_weekday_starts_on_sunday(frame):
    from datetime import date

    df = frame("d date", (date(2024, 6, 2),), (date(2024, 6, 8),))
    assert [r[0] for r in df.orderBy("d").select(S.weekday_number("d")).collect()] == [0, 6]
