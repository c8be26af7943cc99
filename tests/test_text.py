"""FIXTURES.md §4: word counts, both empty-token policies."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martkit.functions import split_words, word_count
from martkit.sources import text_frame


def counts(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_python_golden(spark):
    df = text_frame(spark, ["Hello Spark Hello Python Hello Airflow Hello World"])
    assert counts(word_count(df)) == {"Hello": 4, "Spark": 1, "Python": 1, "Airflow": 1, "World": 1}


def test_scala_golden(spark):
    df = text_frame(spark, ["Hello World", "Hello Spark", "Hello Airflow"])
    assert counts(word_count(df, drop_trailing_empty=True)) == {
        "Hello": 3, "World": 1, "Spark": 1, "Airflow": 1}


def test_empty_tokens(spark):
    df = text_frame(spark, ["a  b "])
    assert counts(word_count(df)) == {"a": 1, "b": 1, "": 2}
    assert counts(word_count(df, drop_trailing_empty=True)) == {"a": 1, "b": 1, "": 1}


def test_java_split_edge_cases(spark):
    # Java String.split(" "): no separator → whole string; only separators → nothing;
    # a newline after a trailing space is not a trailing empty token.
    cases = {"": [""], " ": [], "   ": [], "abc": ["abc"], "  a": ["", "", "a"],
             "a \n": ["a", "\n"], "a b  ": ["a", "b"]}
    df = text_frame(spark, list(cases))
    got = {r["text"]: list(r["t"]) for r in
           df.select("text", split_words("text", drop_trailing_empty=True).alias("t")).collect()}
    assert got == cases


def test_regex_characters_are_literal(spark):
    df = text_frame(spark, ["a.b.c", "a|b"])
    got = [list(r["t"]) for r in df.select(split_words("text", ".").alias("t")).collect()]
    assert got == [["a", "b", "c"], ["a|b"]]
    got = [list(r["t"]) for r in df.select(split_words("text", "|").alias("t")).collect()]
    assert got == [["a.b.c"], ["a", "b"]]


def _java_split(text, sep):
    """Java ``String.split`` on a literal: no match → whole; trailing empties dropped."""
    if sep not in text:
        return [text]
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts



@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="ab .\n", max_size=8), min_size=1, max_size=12))
def test_split_policies_match_python_and_java(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for sep in (" ", ". "):
        got = df.select(split_words("t", sep).alias("p"),
                        split_words("t", sep, drop_trailing_empty=True).alias("j")).collect()
        assert [list(r.p) for r in got] == [t.split(sep) for t in texts], sep
        assert [list(r.j) for r in got] == [_java_split(t, sep) for t in texts], sep
