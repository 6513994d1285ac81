import pytest
from pyspark.sql import functions as F

from calyx.functions.params import has_key, parse_params, with_parsed_params

# FIXTURES §3 `params` frame
CASES = [
    (None, {}),
    ("", {}),
    ("{}", {}),
    ("{'lis_result_sourcedid': None, 'lesson_id': 3}", {"lesson_id": "3"}),
    ("{'graded': True, 'score': 7.5}", {"graded": "true", "score": "7.5"}),
    ("{'oauth_consumer_key': 'a: None, b'}", {"oauth_consumer_key": "a: None, b"}),
    ("{'oauth_consumer_key': \"it's\"}", {"oauth_consumer_key": "it's"}),
    ("{'oauth_consumer_key': 'it\\'s \"q\"'}", {"oauth_consumer_key": "it's \"q\""}),
    ("{'oauth_consumer_key': 'NoneTrue', 'score': False}",
     {"oauth_consumer_key": "NoneTrue", "score": "false"}),
    ("{'oauth_consumer_key': '\\x41\\\\x41'}", {"oauth_consumer_key": "A\\x41"}),
]
BAD = ["bad{", "{'a': (1, 2)}", "{'a': {1, 2}}", "{'a': b'x'}"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def fields(row):
    return {k: v for k, v in row.asDict().items() if v is not None}


def test_lenient_values(spark):
    df = frame(spark, [c[0] for c in CASES] + BAD)
    got = df.orderBy("i").select(parse_params(F.col("t"), strict=False).alias("p")).collect()
    want = [c[1] for c in CASES] + [{}] * len(BAD)
    assert [fields(r.p) for r in got] == want


def test_dataframe_form_matches_column_form(spark):
    df = frame(spark, [c[0] for c in CASES] + BAD)
    a = df.select("i", parse_params(F.col("t"), strict=False).alias("p"))
    b = with_parsed_params(df, "t", "p", strict=False).select("i", "p")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_strict_fails_on_corrupt(spark):
    with pytest.raises(Exception, match="corrupt passback_params"):
        frame(spark, ["{'a': 1}", "bad{"]).select(parse_params(F.col("t"))).collect()


def test_strict_accepts_clean(spark):
    df = frame(spark, [c[0] for c in CASES])
    assert with_parsed_params(df, "t").count() == len(CASES)


def test_key_presence(spark):
    df = frame(spark, ["{'score': None}", "{'x': 1}", "{'a': 'score'}"])
    got = [r.k for r in df.orderBy("i").select(has_key(F.col("t"), "score").alias("k")).collect()]
    assert got == [True, False, False]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

ALPHABET = st.sampled_from(list("ab '\"\\:,{}\n\t\x07éж") + ["None", "True", "False", ": None, "])
TEXT = st.lists(ALPHABET, max_size=8).map("".join)
VALUE = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), TEXT)
KEYS = ("oauth_consumer_key", "lis_result_sourcedid", "lis_outcome_service_url")


def expected(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.fixed_dictionaries({k: VALUE for k in KEYS}), min_size=1, max_size=10))
def test_repr_round_trip(spark, dicts):
    texts = [repr(d) for d in dicts]
    df = frame(spark, texts)
    got = df.orderBy("i").select(parse_params(F.col("t"), keys=KEYS).alias("p")).collect()
    for d, r in zip(dicts, got):
        assert {k: getattr(r.p, k) for k in KEYS} == {k: expected(d[k]) for k in KEYS}, repr(d)
