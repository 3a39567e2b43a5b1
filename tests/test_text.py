"""Text preparation: literal cases and invariants."""

import random

import pytest
from pyspark.sql import functions as F

from ticketlens.functions import stopwords
from ticketlens.functions import text as tx
from ticketlens.operators import prepare as pr


def normalize(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    rows = df.select("i", tx.normalize_chars(F.col("t")).alias("c")).orderBy("i").collect()
    return [r.c for r in rows]


# text → what the rules leave of it, written out by hand
EXPECTED = [
    ("Visit www.example.org/page?x=1 now", "visit url now"),
    ("Mail to Ann_Lee@mail.example by 17:30, see http://a.example/x!", "mail to email by number number see url"),
    ("abc123def 4567", "abc number def number"),
    ("__init__ and ___", "init and"),
    ("ＦＵＬＬ ｗｉｄｔｈ ﬁle x² ½", "full width file x number number number"),
    ("café naïve", "café naïve"),
    ("a b\x1cc\x85d e\u3000f", "a b c d e f"),
    ("", ""),
    (None, ""),
    ("   padded   ", "padded"),
    ("<john@x.com> done", "email done"),
    ("Ünïcödé ß", "ünïcödé ß"),
    ("١٢٣ ٤", "number number"),
]


def test_literal_rows(spark):
    assert normalize(spark, [t for t, _ in EXPECTED]) == [e for _, e in EXPECTED]


def test_random_strings_keep_the_rules(spark):
    """What is left holds no upper case, digit, punctuation or doubled space, and is left alone by a second pass."""
    rng = random.Random(7)
    alphabet = list("ab Z_-.@:/#1 9") + ["é", "\u0301", "\u00a0", "\x85", "\u2009", "ﬁ", "²", "٣", "\t", "\n", "!"]
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    first = normalize(spark, values)
    for text in first:
        assert text == text.lower() == " ".join(text.split())
        assert not any(c.isdigit() or c in "_-.@:/#!" for c in text)
    assert normalize(spark, first) == first


def prepared(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return pr.prepare_tickets(df)


def test_missing_body_raises(spark):
    df = spark.createDataFrame([("printer issue",)], "subject string")
    with pytest.raises(KeyError, match="no text column named body"):
        pr.prepare_tickets(df)


def test_missing_subject_is_tolerated(spark):
    out = prepared(spark, [("Lift 7 is stuck",)], "body string").first()
    assert out[pr.COMBINED] == "Lift 7 is stuck"


def test_combine_strips_unicode_space(spark):
    out = prepared(spark, [("  Hello  ", "\tworld \x85")], "subject string, body string").first()
    assert out[pr.COMBINED] == "Hello world"


def test_english_stop_words_removed(spark):
    out = prepared(spark, [("", "The heating in our office is very cold", "en")], "subject string, body string, language string")
    assert out.first()[pr.CLEANED] == "heating office cold"


def test_language_prefix_rules(spark):
    rows = [
        ("", "Das ist ein Problem", "de-AT"),
        ("", "This is an issue", "EN"),
        ("", "This is an issue", " en"),
        ("", "This is an issue", None),
        ("", "This is an issue", "fr"),
    ]
    out = prepared(spark, rows, "subject string, body string, language string").collect()
    got = [r[pr.CLEANED] for r in out]
    assert got == ["problem", "issue", "this is an issue", "this is an issue", "this is an issue"]


def test_no_stop_list_keeps_text(spark, monkeypatch):
    monkeypatch.setattr(stopwords, "lists_by_prefix", lambda: [("de", ()), ("en", ())])
    out = prepared(spark, [("", "The heating is cold", "en")], "subject string, body string, language string")
    assert out.first()[pr.CLEANED] == "the heating is cold"


def test_slice_language(spark):
    df = spark.createDataFrame([(" EN ",), ("",), (None,), (" ",), ("Middle East",)], "l string")
    got = [r.s for r in df.select(tx.language_for_slices(F.col("l")).alias("s")).collect()]
    assert got == ["en", "unknown", "unknown", "unknown", "middle east"]


def test_slugs(spark):
    df = spark.createDataFrame([("Technical  Support",), ("  Sales and Pre-Sales ",)], "v string")
    got = [r.s for r in df.select(tx.metric_slug(F.col("v")).alias("s")).collect()]
    assert got == ["technical_support", "sales_and_pre-sales"]
    df = spark.createDataFrame([("smoke test/run #1",), ("///",), ("a.b_c-d",)], "v string")
    got = [r.s for r in df.select(tx.run_slug(F.col("v")).alias("s")).collect()]
    assert got == ["smoke-test-run-1", "run", "a.b_c-d"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["aa", "bb", "cc", "dd"],), (["aa"],), ([],)], "w array<string>")
    got = [r.g for r in df.select(tx.ngrams_1_to(F.col("w"), 3).alias("g")).collect()]
    assert got[0] == ["aa", "bb", "cc", "dd", "aa bb", "bb cc", "cc dd", "aa bb cc", "bb cc dd"]
    assert got[1] == ["aa"]
    assert got[2] == []


def test_request_validation(spark):
    from ticketlens.sources.tickets import validate_requests

    df = spark.createDataFrame([(1, "printer", "broken"), (2, "", "x"), (3, "s", None)], "id long, subject string, body string")
    got = {r.id: (r.accepted, r.reason) for r in validate_requests(df).collect()}
    assert got == {1: (True, None), 2: (False, "empty subject"), 3: (False, "missing body")}
    no_body = spark.createDataFrame([(4, "only a subject")], "id long, subject string")
    assert validate_requests(no_body).first().reason == "missing body"
