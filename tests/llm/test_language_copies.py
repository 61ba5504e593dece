"""Copies of a text do not take places of the language sample."""

from pairloom.llm import language


def test_copies_teach_once(spark):
    texts = [f"word{k} again" for k in range(40)]
    once = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    many = spark.createDataFrame([("en", t) for k, t in enumerate(texts) for _ in range(200 if k % 4 == 0 else 1)], "lang string, text string")
    want, got = language.fit(once, sample=20), language.fit(many, sample=20)
    assert got.step == want.step and got.escape == want.escape
