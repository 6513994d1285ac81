"""Attempt records as the API delivers them (SRC1, SRC4) and the
deterministic synthetic café orders (SRC6).

``api_records`` renders the events table into the API's record shape —
``passback_params`` as a Python dict-literal string, ``is_correct`` as
0/1/NULL, ``created_at`` as text — so the normalisation operators run on
records whose expected values are known from the events columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from .tables import read_table

# Format of created_at in the API records: Python's str(datetime), which leaves
# the fraction out when it is 0.
CREATED_AT_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

RECORD_SCHEMA = T.StructType([
    T.StructField("lti_user_id", T.StringType()),
    T.StructField("passback_params", T.StringType()),
    T.StructField("is_correct", T.IntegerType()),
    T.StructField("attempt_type", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("score", T.DecimalType(10, 2)),
])


def _q(s: Column) -> Column:
    """Single-quoted Python string token (values contain no quote or backslash)."""
    return F.concat(F.lit("'"), s, F.lit("'"))


def render_params(ev: DataFrame, corrupt: bool = False) -> Column:
    """The dict literal for an events row.

    Covers the literal forms seen in API data: None values, True/False, bare
    numbers, a double-quoted string holding an apostrophe, a single-quoted
    string with an escaped ``\\'``, text containing ``: None,``, an empty
    string as score (users ending in 3, from 20 on), a lesson name of its own
    (users ending in 4 have none) and (types 'click') a missing ``score`` key.
    With ``corrupt`` the 'error' rows with value < 1 carry truncated text.
    """
    v, et, eid = F.col("value"), F.col("event_type"), F.col("event_id").cast("string")
    sourcedid = F.when(v < 5, F.lit("None")).otherwise(_q(F.concat(F.lit("src:"), eid)))
    url = (F.when(et == "view", F.concat(F.lit("\"https://lms.example/view?it's="), eid, F.lit("\"")))
            .when(et == "error", F.lit("'https://lms.example/error?msg=it\\'s \"bad\"'"))
            .when(et == "signup", F.lit("'note: None, ok'"))
            .otherwise(_q(F.concat(F.lit("https://lms.example/"), et))))
    ending = F.pmod(F.col("user_id").cast("long"), F.lit(10))
    name = F.when(ending == 4, F.lit("None")).otherwise(
        F.concat(F.lit("'Lesson no. "), F.get_json_object("props", "$.k"), F.lit(" by "), et, F.lit("'")))
    score = (F.when(v < 10, F.lit("None")).when(v < 20, F.lit("0")).when(ending == 3, F.lit("''"))
              .otherwise(v.cast("decimal(10,2)").cast("string")))
    score_part = F.when(et == "click", F.lit("")).otherwise(F.concat(F.lit(", 'score': "), score))
    text = F.concat(
        F.lit("{'oauth_consumer_key': "), _q(F.concat(F.lit("key-"), F.col("user_id").cast("string"))),
        F.lit(", 'lis_result_sourcedid': "), sourcedid,
        F.lit(", 'lis_outcome_service_url': "), url,
        F.lit(", 'lesson_id': "), F.get_json_object("props", "$.k"),
        F.lit(", 'lesson_name': "), name,
        score_part,
        F.lit(", 'graded': "), F.when(v >= 30, F.lit("True")).otherwise(F.lit("False")),
        F.lit("}"))
    if corrupt:
        text = F.when((et == "error") & (v < 1), F.concat(F.lit("bad{"), eid)).otherwise(text)
    return text


def outer_score(ev_user: Column) -> Column:
    """Record-level score: NULL for users ending in 1, 0 for users ending in 0, else the id."""
    u = ev_user.cast("long")
    return (F.when(F.pmod(u, F.lit(10)) == 1, F.lit(None))
             .when(F.pmod(u, F.lit(10)) == 0, F.lit(0))
             .otherwise(u).cast("decimal(10,2)"))


def _python_text(ts: Column) -> Column:
    """str(datetime): the fraction only when it is not 0."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")


def api_records(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """Events rendered as API attempt records (plus ``event_id`` for traceability)."""
    ev = read_table(spark, sf_dir, "events")
    v = F.col("value")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("lti_user_id"),
        render_params(ev, corrupt).alias("passback_params"),
        # a flag of 2 (users ending in 7) is truthy, but not 1
        F.when(v < 5, F.lit(None)).when(v < 30, 0)
         .when(F.pmod(F.col("user_id").cast("long"), F.lit(10)) == 7, 2).otherwise(1)
         .cast("int").alias("is_correct"),
        F.col("event_type").alias("attempt_type"),
        _python_text(F.col("ts")).alias("created_at"),
        outer_score(F.col("user_id")).alias("score"),
    )


def landing(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """JSON attempt records as they landed, with ``_corrupt_record`` holding text that is none.

    One record or array per line by default (splittable); ``multi_line`` reads
    each file as one document, such as a pretty-printed response body.
    """
    schema = T.StructType(RECORD_SCHEMA.fields + [T.StructField("event_id", T.LongType()),
                                                  T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("multiLine", str(multi_line).lower()).json(path)


def rejected_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The texts under ``path`` that are no attempt records."""
    bad = landing(spark, path, multi_line).filter(F.col("_corrupt_record").isNotNull())
    return bad.select("_corrupt_record", F.col("lti_user_id").alias("_lti_user_id"))


def read_attempts(spark: SparkSession, path: str, start, end, multi_line: bool = False,
                  on_bad: str = "fail") -> DataFrame:
    """SRC1 — JSON attempt records in ``path`` with ``start <= created_at < end``.

    The schema is given (no inference pass); ``created_at`` is parsed from
    the API's text form, with or without a fraction, before the period filter
    (F15). Text that is no record fails the query; with ``on_bad="reject"`` it is
    left to ``rejected_records``.
    """
    df = landing(spark, path, multi_line)
    bad = F.col("_corrupt_record").isNotNull()
    if on_bad == "fail":
        text = F.raise_error(F.concat(F.lit("no attempt record: "), F.col("_corrupt_record"))).cast("string")
        df = df.withColumn("created_at", F.when(bad, text).otherwise(F.col("created_at")))
    elif on_bad == "reject":
        df = df.filter(~bad)
    else:
        raise ValueError(f"on_bad is {on_bad!r}, not 'fail' or 'reject'")
    ts = F.to_timestamp_ntz(F.col("created_at"), F.lit(CREATED_AT_FORMAT))
    s = cal.as_date(start).cast("timestamp_ntz")
    e = cal.as_date(end).cast("timestamp_ntz")
    return df.drop("_corrupt_record").filter((ts >= s) & (ts < e))


def read_all_strings(spark: SparkSession, path: str, period_start, period_end) -> DataFrame:
    """SRC4 — schema from the keys of all records, every column a string, plus the period columns.

    No schema is inferred: JSON lines are read as maps of strings and their keys
    are a grouped distinct (a row per key reaches the driver); columns stand in
    the keys' order. Nested values stay JSON text; a line that is no JSON object raises.
    """
    values = spark.read.text(path).filter(F.trim("value") != "") \
        .select(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"}).alias("v"))
    keys = [r[0] for r in values.select(F.explode(F.map_keys("v")).alias("k")).distinct().sort("k").collect()]
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).select(
        *[F.col("`" + k.replace("`", "``") + "`") for k in keys], cal.as_date(period_start).alias("_period_start"),
        cal.as_date(period_end).alias("_period_end"))


# The synthetic café's branches and menu (dish, category, price),
# as the reference defines them.
CAFE_BRANCHES = ("Центр", "Север")
CAFE_MENU = (
    ("Пицца", "Основные блюда", "650.00"),
    ("Паста", "Основные блюда", "480.00"),
    ("Кофе", "Напитки", "220.00"),
    ("Чизкейк", "Десерты", "390.00"),
)


def synthetic_orders(days: DataFrame, date_col: str = "report_date",
                     branches=CAFE_BRANCHES, menu=CAFE_MENU) -> DataFrame:
    """SRC6 — one row per date × branch × dish, quantity seeded by the three values.

    Each date row is expanded by a generator over the fixed branch × menu
    list (constant fan-out, no join).  Quantity is 5..40 like the reference's
    date-seeded draw, here the first 8 hex digits of md5(date, branch, dish)
    modulo 36, plus 5: the same date gives the same rows on every re-run.
    """
    combos = F.array(*[
        F.struct(F.lit(b).alias("branch"), F.lit(d).alias("dish"), F.lit(c).alias("category"),
                 F.lit(p).cast("decimal(10,2)").alias("price"))
        for b in branches for (d, c, p) in menu])
    x = days.select(F.col(date_col).cast("date").alias("report_date"),
                    F.explode(combos).alias("_c")).select("report_date", "_c.*")
    seed = F.substring(F.md5(F.concat(F.col("report_date").cast("string"), "branch", "dish")), 1, 8)
    qty = F.pmod(F.conv(seed, 16, 10).cast("bigint"), F.lit(36)) + 5
    return x.withColumn("qty", qty).withColumn(
        "amount", (F.col("qty") * F.col("price")).cast("decimal(12,2)"))
