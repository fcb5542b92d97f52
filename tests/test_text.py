"""Edge rows of the text expressions."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.fixed_values import STOP_WORDS


def evaluate(spark, column, *values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, text string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def expected_tokens(value):
    words = re.sub("[^-.a-zA-Z]", " ", value).lower().split()
    return [w for w in words if len(w) > 2 and w not in STOP_WORDS]


CASES = [
    "today is a good day.",
    "HEAD-TO-TOE® BABY.com",
    "",
    "a",
    "ab",
    "İstanbul Kelvin straße naïve Éclair",
    "x-- .. ... a.b-c\tTab\nline",
    "The THE the those",
]


def test_tokens(spark):
    got = evaluate(spark, text.tokens("text"), *CASES, None)
    assert got == [expected_tokens(c) for c in CASES] + [[]]
    assert got[0] == ["today", "good", "day."]
    assert got[1] == ["head-to-toe", "baby.com"]


def test_runs_and_norm(spark):
    value = "red blue red green blue red"
    got = evaluate(spark, F.expr(text.token_runs_sql(text.tokens_sql("text"))), value, "")
    assert [(r.term, r.c) for r in got[0]] == [("blue", 2), ("green", 1), ("red", 3)]
    assert got[1] == []
    norms = evaluate(spark, F.expr(text.norm_sql(text.tokens_sql("text"))), value, "", "one two six")
    assert norms == pytest.approx([14**0.5, 0.0, 3**0.5])


def test_language_window(spark):
    long = "".join(chr(97 + i % 26) for i in range(1401))
    got = evaluate(spark, text.language_window("text"), long, long[:1400], "")
    assert got == [long[400:1400], long[:1400], ""]


def test_trigrams_are_code_points(spark):
    got = evaluate(spark, F.expr(text.trigrams_sql("text")), "ab\ncd", "é😀ñx", "ab", "", None)
    assert got == [["ab\n", "b\nc", "\ncd"], ["é😀ñ", "😀ñx"], [], [], []]


def test_array_text(spark):
    assert evaluate(spark, text.decode_array_text(F.col("text")), "{a,b}", "{0.5}") == [["a", "b"], ["0.5"]]
